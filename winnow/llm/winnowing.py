"""Document fingerprints by winnowing, in DataFrame functions only.

A text is cut into small units, k-gram hashes roll over them one unit at a time, and the smallest
hash of each window of grams is chosen, the rightmost of equal ones, with its position. Two texts
that share a run of ``k + window - 1`` units share a chosen hash.

A unit is up to three characters of a word, counted from its beginning, or one character of a
script written without blanks. So short texts and texts without blanks have many units too, and
an edit shifts units no further than to the end of its word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.shared import splits, whole_text

GRAM = 6
WINDOW = 6
# Mersenne prime below 2 ** 31 and a multiplier under it: products stay within a long.
_PRIME = 2**31 - 1
_BASE = 1_000_003
_BLANKS = r" \t\n\x0B\f\r"
# Thai and Lao, then Han, Kana, Hangul and the symbols between them, then rarer Han characters.
_UNSPACED = r"\u0E00-\u0EFF\u2E80-\uD7AF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
_UNIT = f"[{_UNSPACED}]|[^{_BLANKS}{_UNSPACED}]{{1,3}}"


def _from(array: Column, place: int) -> Column:
    """The array from its ``place``-th element (0: the first) on."""
    return F.slice(array, F.lit(place + 1), F.greatest(F.size(array) - place, F.lit(0)))


def _joined(left: Column, right: Column, at: int, size: int) -> Column:
    """Hashes of grams of ``at + size`` units from those of ``at`` and of ``size`` units."""
    power = pow(_BASE, size, _PRIME)

    def join(gram, more):
        return F.pmod(gram * power + F.coalesce(more, F.lit(0)), F.lit(_PRIME))

    return F.zip_with(left, _from(right, at), join)


def _smaller(mins: Column, step: int) -> Column:
    """Minimum of each element and the one ``step`` places on, if there is one."""
    return F.zip_with(mins, _from(mins, step), lambda a, b: F.least(a, b))


def with_fingerprint(
    df: DataFrame, text: str, prefix: str, gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """Adds ``<prefix>fingerprint`` and ``<prefix>hashes``, its distinct hashes.

    The fingerprint lists ``position:hash`` in text order, positions counting units from 0. A
    text of fewer units than a gram has one gram; one of fewer grams than a window has one
    window. Null, empty and blank texts have the fingerprint of one empty unit.
    """
    units, work, count = f"{prefix}units", f"{prefix}work", f"{prefix}count"
    # Each step is a column of its own, so that no array is computed twice.
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_UNIT), F.lit(0))
    df = df.withColumn(units, found)
    hashed = F.transform(units, lambda u: F.pmod(F.xxhash64(u), F.lit(_PRIME)))
    df = df.withColumn(units, F.when(F.size(units) > 0, hashed).otherwise(F.array(F.lit(0))))
    # The polynomial hashes of grams of 1, 2, 4, ... units make up those of ``gram`` units.
    sizes = [1]
    df = df.withColumn(f"{work}1", F.col(units))
    while 2 * sizes[-1] <= gram:
        half = sizes[-1]
        grams = _joined(F.col(f"{work}{half}"), F.col(f"{work}{half}"), half, half)
        df = df.withColumn(f"{work}{2 * half}", grams)
        sizes.append(2 * half)
    at = sizes[-1]
    df = df.withColumn(work, F.col(f"{work}{at}"))
    for size in reversed(sizes):
        if at + size <= gram:
            df = df.withColumn(work, _joined(F.col(work), F.col(f"{work}{size}"), at, size))
            at += size
    df = df.withColumn(count, F.greatest(F.size(units) - (gram - 1), F.lit(1)))
    df = df.drop(units, *[f"{work}{size}" for size in sizes])
    # One long per gram: its hash, then its position counted backwards, so that the smallest
    # long is the smallest hash and of equal hashes the rightmost.
    last = F.lit(2**31 - 1)
    df = df.withColumn(
        work,
        F.transform(
            F.slice(work, F.lit(1), F.col(count)),
            lambda h, i: F.shiftleft(h, 31) + (last - i).cast("long"),
        ),
    )
    span = 1
    while 2 * span <= window:
        df = df.withColumn(work, _smaller(F.col(work), span))
        span *= 2
    if span < window:
        df = df.withColumn(work, _smaller(F.col(work), window - span))
    windows = F.greatest(F.col(count) - (window - 1), F.lit(1))
    df = df.withColumn(work, F.array_distinct(F.slice(work, F.lit(1), windows)))

    def shown(chosen):
        place = last - chosen.bitwiseAND(last)
        return F.concat_ws(":", place.cast("string"), F.lower(F.hex(F.shiftright(chosen, 31))))

    df = df.withColumn(f"{prefix}fingerprint", F.array_join(F.transform(work, shown), " "))
    hashes = F.array_distinct(F.transform(work, lambda c: F.shiftright(c, 31)))
    return df.withColumn(f"{prefix}hashes", hashes).drop(work, count)


def likeness(a: str, b: str) -> Column:
    """Share of common hashes among all hashes of two fingerprints."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def with_next(docs: DataFrame, parts: int | None = None) -> tuple[DataFrame, Window]:
    """Rows in parts of neighbouring ``doc_id``, and the window of descending order in a part.

    Every part also gets the row that follows its last one, marked ``guest``, so that a lead
    over the window reaches the next row of all: the largest key of the part below, or the
    largest of all for the lowest part. Rows with equal keys follow by a hash of their texts;
    null keys come last, and without other keys their first row is the largest of all.
    """
    rows = whole_text(docs)
    key, mark = F.col("doc_id"), F.xxhash64("text")
    parts = parts or 4 * splits(docs)
    shares = [i / parts for i in range(1, parts)] or [0.5]
    row = rows.agg(
        F.percentile_approx("doc_id", shares, max(10_000, 20 * parts)).alias("bounds"),
        F.max("doc_id").alias("most"),
        F.min(F.when(key.isNull(), mark)).alias("unkeyed"),
    ).head()
    # At most ``parts`` keys, each the largest of its part.
    bounds = sorted(set(row["bounds"] or []) - {row["most"]})
    held = F.split(F.lit(",".join(map(str, bounds))), ",") if bounds else F.array()
    held = held.cast("array<long>")
    # Bounds below the key, by binary search; a null key and a place past the end compare as null.
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, len(bounds).bit_length())))])

    def further(below, step):
        return F.when(F.try_element_at(held, below + step) < key, below + step).otherwise(below)

    own = F.aggregate(steps, F.lit(0), further)
    place = F.struct(own.alias("part"), F.lit(0).alias("guest"))
    above = F.struct((own + 1).alias("part"), F.lit(1).alias("guest"))
    lowest = F.struct(F.lit(0).alias("part"), F.lit(2).alias("guest"))
    first = key == row["most"] if row["most"] is not None else mark == row["unkeyed"]
    places = (
        F.when(first, F.array(place, lowest))
        .when(F.try_element_at(held, own + 1) == key, F.array(place, above))
        .otherwise(F.array(place))
    )
    dealt = rows.withColumn("place", F.explode(places)).select("doc_id", "text", "place.*")
    order = [(F.col("guest") == 2).asc(), key.desc_nulls_last(), mark]
    return dealt, Window.partitionBy("part").orderBy(*order)


def edited_fingerprints(
    docs: DataFrame, gram: int = GRAM, window: int = WINDOW, parts: int | None = None
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has the last third of the code points replaced by the first as many of the
    next document in descending ``doc_id`` order; after the last comes the first. A null text is
    empty. A lone document is its own next. Other columns are left out; no rows give no rows.
    """
    dealt, order = with_next(docs, parts)
    cut = F.expr("n_chars div 3")
    rows = (
        dealt.withColumn("next", F.coalesce(F.lead("text").over(order), "text"))
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn("cut", cut.cast("int"))
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), (F.col("n_chars") - F.col("cut")).cast("int")),
                F.substring("next", F.lit(1), F.col("cut")),
            ),
        )
        .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    )
    rows = with_fingerprint(rows, "text", "", gram, window)
    rows = rows.withColumn("next_hashes", F.coalesce(F.lead("hashes").over(order), "hashes"))
    rows = with_fingerprint(rows.where("guest = 0"), "edited", "edited_", gram, window)
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness("hashes", "edited_hashes").alias("near_edited"),
        likeness("hashes", "next_hashes").alias("near_next"),
    )
