"""Operator 5, secret scan with character Markov models; DataFrame operations only.

Fixed patterns find the base spans. Beyond them, long runs of token characters
are judged by two first-order Markov models, one of random strings and one of
ordinary identifiers: a run whose log-likelihood ratio passes the margin is a
secret. Both models are transition counts, of the words of all rows and of
generated random strings, aggregated by Spark; what reaches the driver is one
count per pair of characters and label.

Positions are code points. They follow from cutting the text at the matches:
a match starts after all pieces and matches before it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base spans, in the order of their kinds; keyword letters in either case.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 and more: a shorter run holds no longer match
HEX = r"[0-9a-f]{24,}"  # likewise [0-9a-f]+ of 24 and more
KINDS = ("assign", "access", "hex", "markov")

#: Runs that the models judge.
RUN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
#: Characters of the models; any other counts as one more.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
STATES = len(ALPHABET) + 1
#: The code that stands for all characters past ASCII while transitions are counted.
OTHER = 128

SPANS = "array<struct<start:int,kind:int,end:int,token:string>>"
#: Elements of an array that are folded together, and a place behind every text.
BLOCK, NOWHERE = 256, 2**31 - 1

#: Generated strings of each form.
GENERATED = 2000
#: Nats by which the random model must be the likelier.
MARGIN = 10.0


def _codes(token: Column) -> Column:
    """The characters' places in the alphabet, 0 for others."""
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def labelled_samples(docs: DataFrame, pages: DataFrame | None = None, rows: int = GENERATED) -> DataFrame:
    """``token, random``: the identifiers (0) of all rows, and generated random strings (1).

    Identifiers are the words and numbers of all texts, the parts of all
    addresses and ``rows`` generated numbers. Random strings, ``rows`` of each
    form, are digests written as hexadecimal, base64 and capitals with digits.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("text").alias("value"))
    words = texts.select(F.explode(F.regexp_extract_all("value", F.lit(r"[A-Za-z0-9_-]{4,}"), F.lit(0))).alias("token"))
    # What the base patterns take for a secret is no example of an identifier.
    words = words.where(~F.col("token").rlike(f"^(?:{ACCESS}|{HEX})$"))
    plain = words
    if pages is not None:
        urls = pages.select(F.col("url").alias("value"))
        plain = plain.union(urls.select(F.explode(F.regexp_extract_all("value", F.lit(r"[A-Za-z0-9/_-]{4,}"), F.lit(0)))))
    seeds = spark.range(rows).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    numbers = spark.range(rows).select((F.abs(F.xxhash64("id")) % F.lit(10**16)).cast("string").alias("token"))
    plain = plain.union(numbers)
    capitals = F.translate(F.upper(F.base64(F.unhex("h"))), "+/=", "")
    random = seeds.select(F.explode(F.array(F.lower("h"), F.base64(F.unhex("h")), F.substring(capitals, 1, 40), F.substring(F.lower("h"), 1, 20))))
    return plain.select("token", F.lit(0).alias("random")).union(random.select("col", F.lit(1)))


def train(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratios of all transitions, random over identifier, by ``first * STATES + second``.

    Tokens that are null or shorter than two characters have no transition; a
    label without samples gives a uniform model.
    """
    codes = samples.where(F.length("token") >= 2).select("random", F.transform(F.split("token", ""), lambda c: F.least(F.ascii(c), F.lit(OTHER))).alias("c"))
    pairs = F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1), lambda a, b: a * (OTHER + 1) + b)
    steps = codes.select("random", F.explode(pairs).alias("step"))
    place = [ALPHABET.find(chr(c)) + 1 for c in range(OTHER + 1)]
    counts: Counter = Counter()
    for r in steps.groupBy("random", "step").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.random, place[r.step // (OTHER + 1)], place[r.step % (OTHER + 1)]] += r.n
    sums = {(y, a): sum(counts.get((y, a, b), 0) for b in range(STATES)) for y in (0, 1) for a in range(STATES)}

    def chance(y: int, a: int, b: int) -> float:
        return (counts.get((y, a, b), 0) + smoothing) / (sums[y, a] + smoothing * STATES)

    return [log(chance(1, a, b) / chance(0, a, b)) for a in range(STATES) for b in range(STATES)]


def ratio(token: Column, model: list[float]) -> Column:
    """The token's log-likelihood ratio, random over identifier, in nats."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    pairs = lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: a * STATES + b)
    # The codes are made once and handed on as the only element of an array.
    steps = F.flatten(F.transform(F.array(_codes(token)), pairs))
    return F.aggregate(steps, F.lit(0.0), lambda total, k: total + F.get(table, k))


def running(values: Column, zero: int, step: Callable[[Column, Column], Column]) -> Column:
    """``step`` folded along an array of integers, after every element.

    Appending to an array copies it, so the elements are folded in blocks of
    ``BLOCK``: the work for n of them is n * BLOCK + (n / BLOCK)**2 copied values.
    """
    last = lambda a: F.element_at(a, -1)
    within = lambda block, start: F.aggregate(block, F.array(start), lambda a, x: F.concat(a, F.array(step(last(a), x))))

    def folded(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / BLOCK).cast("int")), lambda k: F.slice(v, k * BLOCK + 1, BLOCK))
        lists = F.aggregate(blocks, F.array(F.array(F.lit(zero))), lambda a, block: F.concat(a, F.array(within(block, last(last(a))))))
        # The first of each list is the value before its block; the first list is the start alone.
        return F.flatten(F.transform(lists, lambda a: F.slice(a, 2, BLOCK)))

    # The values are made once and handed on as the only element of an array.
    return F.flatten(F.transform(F.array(values), folded))


def match_spans(text: Column, pattern: str, kind: int, found: Column, keep: Column | None = None) -> Column:
    """``array<struct<start, kind, end, token>>`` of the matches ``found`` in ``text``; ``keep``: whether each counts."""
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    none = F.array().cast(SPANS)
    ends = running(F.zip_with(gaps, found, lambda gap, token: F.length(gap) + F.length(token)), 0, lambda at, n: at + n)
    keep = F.transform(found, lambda m: F.lit(True)) if keep is None else keep
    rows = F.filter(F.arrays_zip(ends.alias("end"), found.alias("token"), keep.alias("keep")), lambda r: r["keep"])
    span = lambda r: F.struct(
        (r["end"] - F.length(r["token"])).alias("start"), F.lit(kind).alias("kind"), r["end"].alias("end"), r["token"].alias("token")
    )
    return F.when(F.size(found) > 0, F.transform(rows, span)).otherwise(none)


def untouched(runs: Column, base: Column) -> Column:
    """The ``runs`` that overlap no span of ``base``, from one walk each way over all spans by start."""

    def free(spans: Column) -> Column:
        is_run = lambda s: s["kind"] == len(KINDS) - 1
        reach = running(F.transform(spans, lambda s: F.when(is_run(s), 0).otherwise(s["end"])), 0, F.greatest)
        ahead = F.transform(F.reverse(spans), lambda s: F.when(is_run(s), NOWHERE).otherwise(s["start"]))
        ahead = F.reverse(running(ahead, NOWHERE, F.least))
        rows = F.arrays_zip(spans.alias("span"), reach.alias("reach"), ahead.alias("ahead"))
        kept = F.filter(rows, lambda r: is_run(r["span"]) & (r["reach"] <= r["span"]["start"]) & (r["ahead"] >= r["span"]["end"]))
        return F.transform(kept, lambda r: r["span"])

    both = F.flatten(F.transform(F.array(F.sort_array(F.concat(base, runs))), free))
    return F.when((F.size(runs) > 0) & (F.size(base) > 0), both).otherwise(runs)


def scan_secrets(docs: DataFrame, model: list[float], margin: float = MARGIN) -> DataFrame:
    """``doc_id, base, markov`` for every row: arrays of ``struct<start, kind, end, token>``, ends exclusive.

    ``base`` holds the fixed patterns' matches, leftmost and not overlapping
    within a kind; ``markov`` the runs that the models take for random and that
    no base span touches.

    Edge cases: a null or empty text has no spans. Repeated rows and null ids
    are scanned like any other. Whole texts are read, whatever their length.
    No rows give no rows. Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    every = lambda pattern, group=0: F.regexp_extract_all("t", F.lit(pattern), F.lit(group))
    rows = docs.select("doc_id", text.alias("t"))
    rows = rows.select("doc_id", "t", every(ASSIGN).alias("a"), every(ACCESS).alias("k"), every(HEX).alias("h"), every(RUN).alias("r"))
    long = F.transform(every(ASSIGN, 2), lambda value: F.length(value) >= 6)
    t = F.col("t")
    rows = rows.select(
        "doc_id",
        F.concat(
            match_spans(t, ASSIGN, 0, F.col("a"), F.when(F.size("a") > 0, long).otherwise(F.array().cast("array<boolean>"))),
            match_spans(t, ACCESS, 1, F.col("k")),
            match_spans(t, HEX, 2, F.col("h")),
        ).alias("base"),
        match_spans(t, RUN, 3, F.col("r"), F.transform("r", lambda run: ratio(run, model) > margin)).alias("runs"),
    )
    return rows.select("doc_id", F.sort_array("base").alias("base"), untouched(F.col("runs"), F.col("base")).alias("markov"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of the spans by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans), text), ",")


def secret_digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns, from the result of ``scan_secrets``."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return scanned.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.concat("base", "markov")).alias("spans"),
    )
