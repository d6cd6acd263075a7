"""Operator 4, license scan with MinHash bands over text windows; DataFrame operations only.

A text's words are covered by overlapping windows; the templates are covered by
windows of the same width at every word, so some template window is aligned
with each document window. Each window's shingles give ``BANDS`` minima, one a
band. A document window that shares a band with a template window retrieves
that template; then the template's shingles are looked up in the region around
the window, and the exact share found (the containment) must reach a floor.

Siblings differ by a word or two, far above that floor. So a template also needs
every shingle that sets it apart: those missing from another template that
reaches the floor for it, and those that end in a version number or in a word
such as Lesser or NonCommercial. They count in place only, in a short stretch that
holds half of the template's shingles around them; a mention elsewhere in the
region does not make a notice.

The setting guarantees retrieval: a window and a template window of Jaccard
similarity s share a band with probability ``1 - (1 - s)**BANDS``: 0.99998 at
one half, which the shortest notice (five words) reaches in some window. Only
windows with a key word are hashed: every template shingle holds one, but for
the few made of common words alone, and these cannot make a window similar.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Words in a shingle and in a window, words from window to window, and bands.
SHINGLE, WINDOW, STRIDE, BANDS = 3, 8, 3, 16
#: Share of a template's shingles that a region must hold, and of those around the ones that set it apart.
CONTAINMENT, IN_PLACE = 0.8, 0.5
#: Words that tell one license of a family from another, and words that a version number follows within three.
MARKS = frozenset("lesser affero library noncommercial sharealike noderivatives noderivs nc sa nd".split())
VERSIONED = MARKS | frozenset("version v license attribution by".split())

WORD = r"[^a-z0-9]+"

#: Words too common in any text to be key words.
COMMON = frozenset("a an and any are as at by do for from in is it may not of on or so that the this to under was with you".split())


def words_of(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits."""
    return F.filter(F.split(F.lower(text), WORD), lambda w: w != "")


def _words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def key_words(templates: dict[str, str]) -> list[str]:
    """A set of words with one in every shingle of every template that is not of common words only."""
    shingles = {tuple(w[i : i + SHINGLE]) for w in map(_words, templates.values()) for i in range(max(1, len(w) - SHINGLE + 1))}
    open_, chosen = {s for s in shingles if set(s) - COMMON}, []
    while open_:
        uses = Counter(word for s in open_ for word in set(s) - COMMON)
        best = max(uses, key=lambda word: (uses[word], len(word), word))
        chosen.append(best)
        open_ = {s for s in open_ if best not in s}
    return sorted(chosen)


def _runs(words: list[str]) -> list[tuple[str, ...]]:
    return [tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))]


def apart(templates: dict[str, str], containment: float = CONTAINMENT) -> dict[str, list[tuple[list, list, int]]]:
    """For each template its places that set it apart: ``(shingles needed, shingles around, stretch)``.

    The needed ones lie within ``WINDOW`` of the next; those around lie within
    ``WINDOW`` of a needed one; the stretch counts the shingles from the first
    to the last of them and leaves room for ``WINDOW`` inserted words.
    """
    runs = {k: _runs(w) for k, w in ((k, _words(v)) for k, v in templates.items()) if w}
    out = {}
    for name, own in runs.items():
        words, needed = _words(templates[name]), set()
        for other in runs.values():
            missing = set(own) - set(other)
            if len(set(own)) - len(missing) >= containment * len(set(own)):
                needed |= missing
        for i, word in enumerate(words):
            if word in MARKS or word.isdigit() and VERSIONED & set(words[max(0, i - 3) : i]):
                needed.add(own[max(0, i - SHINGLE + 1)])
        places: list[list[int]] = []
        for i in (i for i, run in enumerate(own) if run in needed):
            if places and i - places[-1][-1] <= WINDOW:
                places[-1].append(i)
            else:
                places.append([i])
        out[name] = []
        for at in places:
            around = own[max(0, at[0] - WINDOW) : at[-1] + WINDOW + 1]
            out[name].append((sorted({own[i] for i in at}), sorted(set(around)), len(around) + WINDOW))
    return out


def _hashes(words: Column) -> Column:
    """Hashes of the runs of ``SHINGLE`` words in their order; fewer words are one run."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, SHINGLE)))


def shingles_of(words: Column) -> Column:
    """Distinct hashes of the runs of ``SHINGLE`` words; fewer words are one run, none give none."""
    return F.when(F.size(words) > 0, F.array_distinct(_hashes(words))).otherwise(F.array().cast("array<bigint>"))


def set_apart(places: Column, region: Column) -> Column:
    """Whether every place of a template lies in some stretch of the region's hashes."""

    def lies(place: Column, hashes: Column) -> Column:
        def fits(i: Column) -> Column:
            stretch = F.slice(hashes, i, place["stretch"])
            whole = F.size(F.array_except(place["needed"], stretch)) == 0
            return whole & (F.size(F.array_intersect(place["around"], stretch)) >= IN_PLACE * F.size(place["around"]))

        # A stretch starts at one of the shingles around.
        return F.exists(F.sequence(F.lit(1), F.size(hashes)), lambda i: F.array_contains(place["around"], F.get(hashes, i - 1)) & fits(i))

    # The hashes are made once and handed on as the only element of an array.
    return F.exists(F.array(_hashes(region)), lambda hashes: F.forall(places, lambda place: lies(place, hashes)))


def band_keys(shingles: Column) -> Column:
    """``array<struct<band, key>>``: the smallest hash under each of ``BANDS`` permutations."""
    return F.array(*[
        F.struct(F.lit(band).alias("band"), F.array_min(F.transform(shingles, lambda s: F.xxhash64(F.lit(band), s))).alias("key"))
        for band in range(BANDS)
    ])


def template_bands(spark: SparkSession, templates: dict[str, str], containment: float = CONTAINMENT) -> tuple[DataFrame, DataFrame]:
    """``(bands, sets)``: the bands of every template window; each template's own shingles, length and places that set it apart."""
    places = apart(templates, containment)
    rows = [Row(license_id=k, words=_words(v), places=places[k]) for k, v in templates.items() if _words(v)]
    runs = "array<array<string>>"
    own = spark.createDataFrame(rows, f"license_id string, words array<string>, places array<struct<needed: {runs}, around: {runs}, stretch: int>>")
    hashed = lambda p: F.struct(*[F.transform(p[c], lambda r: F.xxhash64(r)).alias(c) for c in ("needed", "around")], p["stretch"].alias("stretch"))
    sets = own.select("license_id", shingles_of(F.col("words")).alias("own"), F.size("words").alias("length"), F.transform("places", hashed).alias("places"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(1)))
    windows = own.select("license_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, WINDOW))).alias("w"))
    bands = windows.select("license_id", F.explode(band_keys(shingles_of(F.col("w")))).alias("b"))
    return bands.select("license_id", "b.band", "b.key").distinct(), sets


def scan_licenses(docs: DataFrame, templates: dict[str, str], containment: float = CONTAINMENT) -> DataFrame:
    """``doc_id, license_id, containment, n_windows, first_word`` for each row's templates that are found.

    ``containment`` is the largest share of the template's shingles in one
    region, ``n_windows`` the windows whose region passes, ``first_word`` the
    place of the first such window.

    Edge cases: null and empty texts and those without words hold nothing and
    give no rows. Rows with one ``doc_id`` count together, so a repeated row
    changes ``n_windows`` only. A template without words is never found.
    Templates may overlap; each is reported that is there with what sets it
    apart, siblings too where a region holds both. No rows give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    bands, sets = template_bands(spark, templates, containment)
    keys = key_words({k: v for k, v in templates.items() if _words(v)})
    longest = max((len(_words(v)) for v in templates.values()), default=0)
    reach = longest + WINDOW

    worded = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    # Key words' places, then the starts of the windows that hold one.
    held = F.filter(F.transform("words", lambda w, i: F.when(w.isin(keys), i)), lambda i: i.isNotNull())
    worded = worded.select("doc_id", "words", held.alias("held"))
    first = lambda i: F.ceil(F.greatest(i - (WINDOW - 1), F.lit(0)) / STRIDE).cast("int")
    over = lambda i: F.transform(F.sequence(first(i), F.floor(i / STRIDE).cast("int")), lambda j: j * STRIDE)
    starts = F.array_distinct(F.flatten(F.transform("held", over)))
    cut = lambda s: F.struct(
        s.alias("start"),
        F.slice("words", s + 1, WINDOW).alias("window"),
        F.slice("words", F.greatest(s - reach, F.lit(0)) + 1, 2 * reach + WINDOW).alias("region"),
    )
    # The outer form keeps Spark from computing the array once more in a filter below.
    windows = worded.select("doc_id", F.explode_outer(F.transform(starts, cut)).alias("w")).where("w IS NOT NULL").select("doc_id", "w.*")
    windows = windows.select("doc_id", "start", "region", shingles_of(F.col("window")).alias("shingles"))
    hashed = windows.select("doc_id", "start", "region", F.explode_outer(band_keys(F.col("shingles"))).alias("b"))
    # The template tables are constants of the code, some thousand rows at most.
    retrieved = hashed.join(F.broadcast(bands), (F.col("b.band") == bands["band"]) & (F.col("b.key") == bands["key"]))
    checked = retrieved.select("doc_id", "start", "license_id", "region").join(F.broadcast(sets), "license_id")
    found = F.size(F.array_intersect("own", shingles_of(F.col("region")))) / F.size("own")
    hits = checked.withColumn("containment", found).where((F.col("containment") >= containment) & set_apart(F.col("places"), F.col("region")))
    return hits.groupBy("doc_id", "license_id").agg(
        F.max("containment").alias("containment"), F.countDistinct("start").alias("n_windows"), F.min("start").alias("first_word")
    )
