"""Secret scans: fixed patterns, and strings that look random to two Markov models.

One model of character pairs is trained on random strings, one on ordinary identifiers, from
labelled samples. A token whose log-likelihood under the first exceeds that under the second by
a margin is added to what the patterns find. All of it is DataFrame functions: the models are a table of
character pairs, looked up by position inside the expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import table

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Tokens that the models judge, and those that count as ordinary identifiers or words.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ORDINARY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_-]{16,}(?![A-Za-z0-9+/_=-])"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
KINDS = ("assign", "access", "hex", "random")
#: Random strings generated as labelled samples: so many of each of three forms.
RANDOM_SAMPLES = 3000
#: Log-likelihood ratio per pair of characters from which on a token is reported.
MARGIN = 0.25


def labelled_samples(docs: DataFrame, samples: int = RANDOM_SAMPLES) -> DataFrame:
    """(value, random): ordinary identifiers of all documents, and random strings.

    The random ones are digests of running numbers in base64, hexadecimal and capitals with
    digits; digests are uniform, so they serve as random strings that come out alike each time.
    """
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    capitals = F.translate(F.upper(F.base64(F.unhex(digest))), "+/=", "")
    made = docs.sparkSession.range(samples).select(
        F.explode(F.array(F.translate(F.base64(F.unhex(digest)), "=", ""), digest, capitals)).alias("value"),
        F.lit(True).alias("random"),
    )
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("value"), F.lit(False).alias("random"))
    return words.unionByName(made)


def log_ratios(samples: DataFrame) -> list[float]:
    """log P(b after a | random) - log P(b after a | ordinary), by position of a and b in the alphabet.

    Only counts of pairs reach the driver, two at most for each of the 66 x 66 pairs. Pairs never
    seen get the weight of half an occurrence.
    """
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substr(F.col("value"), i, F.lit(2))))
    rows = samples.where(F.length("value") > 1).select(pair.alias("pair"), "random").groupBy("pair", "random").count().collect()
    size = len(ALPHABET)
    counts = {True: [0.5] * size * size, False: [0.5] * size * size}
    for r in rows:
        a, b = ALPHABET.find(r["pair"][0]), ALPHABET.find(r["pair"][1])
        if a >= 0 and b >= 0:
            counts[r["random"]][a * size + b] += r["count"]
    out = []
    for a in range(size):
        yes, no = (counts[k][a * size : (a + 1) * size] for k in (True, False))
        out += [math.log(y / sum(yes)) - math.log(n / sum(no)) for y, n in zip(yes, no)]
    return out


def matches(text: Column, pattern: str, kind: str, enough: Column | None = None) -> Column:
    """(start, place of kind, end, kind) of every match, in code points.

    The text is split at the matches; what stands before a match are the pieces and matches
    before it. ``enough`` is an array of booleans that says which matches count.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    lengths = F.transform(
        F.arrays_zip(F.slice(pieces, F.lit(1), F.size(found)).alias("p"), found.alias("m")),
        lambda x: F.struct(F.length(x["p"]).alias("gap"), F.length(x["m"]).alias("size")),
    )
    def step(acc, x):
        start = acc["at"] + x["gap"]
        return F.struct((start + x["size"]).alias("at"), F.concat(acc["starts"], F.array(start)).alias("starts"))
    starts = F.aggregate(lengths, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("starts")), step)["starts"]
    spans = F.transform(
        F.arrays_zip(starts.alias("s"), found.alias("m"), (enough if enough is not None else F.transform(found, lambda m: F.lit(True))).alias("ok")),
        lambda x: F.struct(
            x["s"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), (x["s"] + F.length(x["m"])).alias("end"),
            F.lit(kind).alias("kind"), x["m"].alias("found"), x["ok"].alias("ok"),
        ),
    )
    none = F.expr("cast(array() as array<struct<start:int,place:int,end:int,kind:string,found:string,ok:boolean>>)")
    return F.when(F.rlike(text, F.lit(pattern)), F.filter(spans, lambda s: s["ok"])).otherwise(none)


def likelihood_ratio(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's pairs of characters."""
    # One literal for the table: a constant expression, folded once when the query is planned.
    values = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    size = len(ALPHABET)
    pairs = F.sequence(F.lit(1), F.length(token) - 1)
    def one(acc, i):
        a = F.instr(F.lit(ALPHABET), F.substr(token, i, F.lit(1)))
        b = F.instr(F.lit(ALPHABET), F.substr(token, i + 1, F.lit(1)))
        return acc + F.get(values, (a - 1) * size + b - 1)
    return F.aggregate(pairs, F.lit(0.0), one) / (F.length(token) - 1)


def joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Spans of each row: (doc_id, base, added), arrays of (start, place, end, kind, found, ok).

    A null text counts as empty; repeated rows are scanned each. A token of the models that
    overlaps a span of the patterns adds nothing, nor does one made of letters alone or digits alone.
    """
    ratios = log_ratios(labelled_samples(docs))
    text = F.coalesce(F.col("text"), F.lit(""))
    long_enough = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= 12)
    base = F.array_sort(
        F.concat(matches(text, ASSIGN, "assign", long_enough), matches(text, ACCESS, "access"), matches(text, HEX, "hex"))
    )
    found = docs.select(F.col("doc_id").cast("bigint"), base.alias("base"), matches(text, TOKEN, "random").alias("tokens"))
    added = F.filter(
        "tokens",
        lambda t: F.rlike(t["found"], F.lit("[0-9]"))
        & F.rlike(t["found"], F.lit("[A-Za-z]"))
        & ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
        & (likelihood_ratio(t["found"], ratios) > margin),
    )
    return found.select("doc_id", "base", added.alias("added"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = scan(table(spark, sf_dir, "documents"))
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return spans.select(
        "doc_id",
        *(count(k) for k in KINDS[:3]),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
