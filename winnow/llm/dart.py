"""Near-duplicate groups by DartMinHash signatures.

A document is a weighted set of five-word shingles. Darts, points of a hashed Poisson process
over (weight, rank), are thrown into the region of each shingle up to its weight; the earliest
dart of each coordinate is the signature, and two signatures agree in a coordinate with the
probability of the weighted Jaccard similarity. Bands of coordinates propose pairs, an exact
comparison decides them, and linked documents form groups.

Equal word sequences are one text from the start. Within a bucket texts are compared with a
centre, not all with all. Where that leaves a bucket with several groups, the texts outside its
largest group are compared with all members of the other groups, in blocks within tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.shared import kept, kept_counted, ready
from winnow.llm.words import mix, slices, words_of

SHINGLE = 5
SIMILARITY = 0.8
# A pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 5) ** 25 = 5e-5.
BANDS = 25
BAND_ROWS = 5
# Rounds of one centre per bucket before what is left is compared in blocks of so many texts.
CENTRES = 2
BLOCK = 512
# Texts signed at once: each throws about 850 darts, however short it is.
SLICE_TEXTS = 500
# Groups of at most so many texts are compared as listed pairs.
FEW = 16
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _step(number: int) -> np.uint64:
    """A multiple of the golden constant modulo 2 ** 64."""
    return np.uint64(int(_GOLDEN) * number % 2**64)


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers over 0 and up to 1."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def shingles_of(texts: pa.Array, size: int = SHINGLE):
    """Document, hash and number of occurrences of each distinct shingle, and a digest.

    A text of fewer words is one shingle; a text without words has none. The digest is that of
    the word sequence.
    """
    words = words_of(texts)
    n, counts = len(words.hash), words.counts
    begins = np.cumsum(counts) - counts
    place = np.arange(n) - begins[words.doc]
    left = counts[words.doc] - place
    rolled = np.zeros(n, np.uint64)
    for back in range(size):
        at = np.minimum(np.arange(n) + back, n - 1)
        inside = left > back
        rolled = np.where(inside, mix(rolled ^ words.hash[at]) + _step(back), rolled)
    full = (left >= size) | (place == 0)
    doc, shingle = words.doc[full], rolled[full]
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(doc)))
    spread = mix(words.hash + _GOLDEN * place.astype(np.uint64))
    other = mix(spread ^ np.uint64(0x5851F42D4C957F2D))
    digest = np.zeros((len(counts), 2), np.uint64)
    some = np.flatnonzero(counts)
    if n:
        digest[some, 0] = np.add.reduceat(spread, begins[some])
        digest[some, 1] = np.add.reduceat(other, begins[some])
    return doc[at], shingle[at], weight.astype(np.float64), digest


def dart_signatures(
    doc: np.ndarray, element: np.ndarray, weight: np.ndarray, sets: int, size: int
) -> np.ndarray:
    """Signature of each weighted set: the earliest dart of each of ``size`` coordinates.

    ``doc`` says which set an element is in. A set with total weight W catches the darts of rank
    below (ln size + 2) * size / W; sets that leave a coordinate empty throw again with twice
    the ranks. Empty sets have zeros.
    """
    out = np.zeros((sets, size), np.uint64)
    total = np.bincount(doc, weight, sets)
    reach = np.zeros(sets)
    reach[total > 0] = (np.log(size) + 2) * size / total[total > 0]
    open_sets = total > 0
    while open_sets.any():
        use = open_sets[doc]
        found = _throw(doc[use], element[use], weight[use], reach, sets, size)
        full = open_sets & (found != 0).all(1)
        out[full] = found[full]
        open_sets &= ~full
        reach *= 2
    return out


def _throw(doc, element, weight, reach, sets, size) -> np.ndarray:
    # Weight is cut at 0, 1, 2, 4, ...: level 0 is [0, 1), level b is [2 ** (b - 1), 2 ** b).
    levels = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))), 0).astype(int) + 1
    owner = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(levels) - levels, levels)
    width = np.where(level > 0, 2.0 ** (level - 1), 1.0)
    low = np.where(level > 0, width, 0.0)
    # Ranks are cut into steps of 1 / width, so that a region catches one dart on average.
    steps = np.ceil(reach[doc[owner]] * width).astype(np.int64)
    region = np.repeat(np.arange(len(owner)), steps)
    step = np.arange(len(region)) - np.repeat(np.cumsum(steps) - steps, steps)
    seed = mix(element[owner[region]] + _GOLDEN * (level[region] * 64 + 1).astype(np.uint64))
    seed = mix(seed + _GOLDEN * step.astype(np.uint64))
    arrival = np.zeros(len(region))
    caught: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    number = 1
    while len(region):
        dart = mix(seed + _step(number))
        arrival = arrival - np.log(_unit(dart))
        still = arrival < 1
        region, step, seed, arrival, dart = (
            a[still] for a in (region, step, seed, arrival, dart)
        )
        of = owner[region]
        identity = mix(dart ^ np.uint64(0xD6E8FEB86659FD93))
        rank = (step + arrival) / width[region]
        height = low[region] + width[region] * _unit(mix(identity ^ _GOLDEN))
        hit = (rank < reach[doc[of]]) & (height < weight[of])
        coordinate = (identity[hit] >> np.uint64(32)) % np.uint64(size)
        cell = doc[of[hit]] * size + coordinate.astype(np.int64)
        caught.append((cell, rank[hit], identity[hit] | np.uint64(1)))
        number += 1
    cell, rank, identity = (np.concatenate(c) for c in zip(*caught))
    earliest = np.full(sets * size, np.inf)
    np.minimum.at(earliest, cell, rank)
    first = rank == earliest[cell]
    found = np.zeros(sets * size, np.uint64)
    found[cell[first]] = identity[first]
    return found.reshape(sets, size)


def signatures(rows: DataFrame, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """``row``, ``doc_id``, digest of the word sequence, and one hash per band; none without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", rows=SLICE_TEXTS):
                n = rows.num_rows
                doc, shingle, weight, digest = shingles_of(rows.column("text"))
                signed = dart_signatures(doc, shingle, weight, n, bands * band_rows)
                key = np.zeros((n, bands), np.uint64)
                for row in range(band_rows):
                    key = mix(key ^ signed[:, row::band_rows])
                key = mix(key + _GOLDEN * np.arange(bands, dtype=np.uint64))
                some = (signed != 0).any(1)
                offsets = np.concatenate([[0], np.cumsum(np.where(some, bands, 0))])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("row"),
                        rows.column("doc_id"),
                        pa.array(digest[:, 0].view(np.int64)),
                        pa.array(digest[:, 1].view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(offsets.astype(np.int32)),
                            pa.array(key[some].ravel().view(np.int64)),
                        ),
                    ],
                    names=["row", "doc_id", "digest", "digest2", "bands"],
                )

    text = F.coalesce("text", F.lit("")).alias("text")
    return rows.select("row", "doc_id", text).mapInArrow(
        sign, "row long, doc_id long, digest long, digest2 long, bands array<long>"
    )


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """``id`` and the elements of its text: each shingle as often as it occurs, told apart.

    The similarity of two weighted sets is that of these plain sets.
    """

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", rows=SLICE_TEXTS):
                doc, shingle, weight, _ = shingles_of(rows.column("text"))
                times = weight.astype(np.int64)
                nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                element = mix(np.repeat(shingle, times) + _GOLDEN * nth.astype(np.uint64))
                ends = np.searchsorted(np.repeat(doc, times), np.arange(rows.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id"),
                        pa.ListArray.from_arrays(
                            pa.array(ends.astype(np.int32)), pa.array(element.view(np.int64))
                        ),
                    ],
                    names=["id", "elements"],
                )

    return texts.mapInArrow(collect, "id long, elements array<long>")


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose weighted Jaccard similarity reaches the threshold, exactly."""
    left = sets.select(F.col("id").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    compared = pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("both")
    )
    return compared.where(
        F.col("common") >= similarity * (F.col("both") - F.col("common")) - 1e-9
    ).select("a", "b")


def _components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``id`` and ``root``, the smallest id that links lead to, for each of ``nodes``.

    Each round hooks every root to the smallest root that a link leads to and follows four such
    hooks at once, so even a chain of documents shortens to a quarter in each round.
    """
    state = nodes.select("id", F.col("id").alias("root"))
    while True:
        a = state.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        b = state.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        across = links.join(a, "a").join(b, "b").where("ra <> rb")
        hooks = across.groupBy(F.greatest("ra", "rb").alias("root")).agg(
            F.min(F.least("ra", "rb")).alias("to")
        )
        hooks, number = kept_counted(hooks, "hooks")
        if not number:
            return state
        for _ in range(2):  # hooks lead to smaller roots, so following them ends
            onward = hooks.select(F.col("root").alias("to"), F.col("to").alias("further"))
            hooks = hooks.join(onward, "to", "left").select(
                "root", F.coalesce("further", "to").alias("to")
            )
        moved = state.join(hooks, "root", "left")
        state = kept(moved.select("id", F.coalesce("to", "root").alias("root")), "roots")


def _centre_pairs(placed: DataFrame, number: int) -> DataFrame:
    """Each text of a bucket with the bucket's centre, if that is in another group.

    The centre is the text with the smallest draw, the same draw in all buckets, so texts that
    share many buckets mostly share the centre and are compared once.
    """
    one = F.min_by(F.struct("id", "root"), F.xxhash64("id", F.lit(number))).alias("one")
    centre = placed.groupBy("band").agg(one)
    pairs = placed.join(centre, "band").where("root <> one.root")
    return pairs.select(
        F.greatest("id", "one.id").alias("a"), F.least("id", "one.id").alias("b")
    ).distinct()


def _several(placed: DataFrame) -> DataFrame:
    """Buckets whose texts are not all in one group, with their largest group."""
    groups = placed.groupBy("band").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.mode("root").alias("main")
    )
    return groups.where("least <> most").select("band", "main")


def _links_across(left: DataFrame, right: DataFrame, sets: DataFrame, similarity: float, same: bool) -> DataFrame:
    """Links that join the roots of the texts ``id`` of both sides with the same ``group``.

    Every pair whose roots differ is considered. Where the right side of a group has at most
    ``FEW`` texts, the pairs are listed and compared, at most so many for a text. The others are
    cut into blocks on both sides and a task meets one block of either; it returns only links
    that join two roots which its links have not joined yet, so fewer than it has texts. With
    ``same``, both sides are the same texts and each pair is met once.
    """
    queue = left.groupBy("group").agg(F.count("*").alias("texts"))
    size = right.groupBy("group").agg(F.count("*").alias("members"))
    plan = queue.join(size, "group").select(
        "group",
        (F.col("members") <= FEW).alias("few"),
        F.ceil(F.col("texts") / BLOCK).cast("int").alias("columns"),
        F.ceil(F.col("members") / BLOCK).cast("int").alias("rows"),
    )
    plan = kept(plan, "plan")
    listed = left.join(plan.where("few").select("group"), "group").join(
        right.select("group", F.col("id").alias("other"), F.col("root").alias("other_root")), "group"
    )
    pairs = listed.where("root <> other_root" + (" AND id > other" if same else "")).select(
        F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")
    )
    large = plan.where("NOT few").drop("few")

    def dealt(rows: DataFrame, own: str, first: str, last: str, names: tuple[str, str]) -> DataFrame:
        cut = rows.join(large, "group").withColumn(
            names[0], F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        )
        blocks = F.explode(F.expr(f"sequence({first}, {last})")).alias(names[1])
        return cut.select("group", "id", "root", names[0], blocks).join(sets, "id")

    def meet(_, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            ids, roots = right.column("m_id").to_numpy(), right.column("m_root").to_numpy()
            lists = pa.concat_arrays(right.column("m_elements").chunks)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy()[ends[0] : ends[-1]]
            sizes = np.diff(ends)
            owner = np.repeat(np.arange(len(ids)), sizes)
            joined: dict[int, int] = {}

            def top(root: int) -> int:
                while root in joined:
                    root = joined[root]
                return root

            texts = zip(*(left.column(c).to_pylist() for c in ("id", "root")), left.column("elements"))
            for key, root, own in texts:
                elements = np.sort(own.values.to_numpy())
                if not len(elements):
                    continue
                at = np.minimum(np.searchsorted(elements, values), len(elements) - 1)
                common = np.bincount(owner, elements[at] == values, len(ids))
                close = common >= similarity * (len(elements) + sizes - common) - 1e-9
                for other, its in zip(ids[close].tolist(), roots[close].tolist()):
                    here, there = top(root), top(its)
                    if here != there:
                        joined[max(here, there)] = min(here, there)
                        found.append((max(key, other), min(key, other)))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # Of equal sides a block meets itself and the blocks after it.
    texts = dealt(left, "columns", "j" if same else "0", "rows - 1", ("j", "i"))
    members = dealt(right, "rows", "0", "i" if same else "columns - 1", ("i", "j"))
    # Names of their own, as both sides read ``sets``.
    members = members.select([F.col(c).alias(f"m_{c}") for c in members.columns])
    met = texts.groupBy("group", "i", "j").cogroup(members.groupBy("m_group", "m_i", "m_j"))
    return _similar(pairs.distinct(), sets, similarity).unionByName(
        met.applyInArrow(meet, "a long, b long")
    )


def _left_over(placed: DataFrame, state: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links that join all groups which still meet in a bucket and have a link, exactly.

    A text outside the largest group of its bucket is compared with every member of that group,
    and the texts outside of it with each other.
    """
    outside = kept(placed.where("root <> main").select("band", "id", "root", "main"), "outside")
    waiting = outside.select("id", "root", F.col("main").alias("group")).distinct()
    members = state.select("id", "root", F.col("root").alias("group"))
    others = outside.select("id", "root", F.col("band").alias("group"))
    return _links_across(waiting, members, sets, similarity, False).unionByName(
        _links_across(others, others, sets, similarity, True)
    )


def numbered(docs: DataFrame) -> DataFrame:
    """The rows kept with a number ``row`` of their own."""
    return kept(docs.withColumn("row", F.monotonically_increasing_id()), "rows")


def grouped(
    rows: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """``row``, ``doc_id`` and ``first`` of numbered rows: the key and the number of the row
    that stands for the group, the smallest ``doc_id`` and then the smallest number, a null
    ``doc_id`` last.

    Texts are told apart by their digests alone, so repeated and null keys lose no link.
    """
    signed = kept(signatures(rows, bands, band_rows), "signed")
    stands = F.min(F.struct(F.col("doc_id").isNull().alias("unkeyed"), "doc_id", "row"))
    texts = signed.groupBy("digest", "digest2").agg(
        stands.alias("first"), F.min_by("bands", "row").alias("bands"), F.min("row").alias("id")
    )
    texts = kept(texts, "texts")
    buckets = texts.select("id", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    buckets = kept(buckets.join(shared, "band"), "buckets")
    nodes = kept(buckets.select("id").distinct(), "candidates")
    wanted = rows.select(F.col("row").alias("id"), "text").join(nodes, "id", "left_semi")
    sets = kept(_shingle_sets(wanted), "sets")
    state = nodes.select("id", F.col("id").alias("root"))
    open_buckets, links = buckets, None
    for number in range(CENTRES):
        placed = open_buckets.join(state, "id")
        found, new = kept_counted(_similar(_centre_pairs(placed, number), sets, similarity), "links")
        if new:
            links = found if links is None else links.unionByName(found)
            state = _components(nodes, links)
        several = _several(open_buckets.join(state, "id"))
        open_buckets, left = kept_counted(
            open_buckets.select("id", "band").join(several, "band"), "open"
        )
        if not left:
            break
    else:
        placed = open_buckets.join(state, "id")
        found, new = kept_counted(_left_over(placed, state, sets, similarity), "links")
        if new:
            links = found if links is None else links.unionByName(found)
            state = _components(nodes, links)
    rooted = texts.join(state, "id", "left").select(
        "digest", "digest2", "first", F.coalesce("root", "id").alias("root")
    )
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    by_text = rooted.join(heads, "root").select("digest", "digest2", "head")
    return signed.join(by_text, ["digest", "digest2"]).select(
        "row", "doc_id", F.col("head.doc_id").alias("group_id"), F.col("head.row").alias("first")
    )


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, **options: int) -> DataFrame:
    """``doc_id`` and ``group_id`` of every row.

    ``group_id`` is the smallest ``doc_id`` of the documents that links of at least
    ``similarity`` lead to, null if none of them has one. A document like no other is a group of
    its own; all texts without words are equal and form one group. Rows that repeat a ``doc_id``
    have a row each, under the group of their own text. Other columns are left out.
    """
    ready(docs.sparkSession)
    found = grouped(numbered(docs.select("doc_id", "text")), similarity, **options)
    return found.select("doc_id", "group_id")


def first_of_groups(docs: DataFrame, similarity: float = SIMILARITY, **options: int) -> DataFrame:
    """One row of each near-duplicate group, all columns of ``docs``: that with the smallest
    ``doc_id``, a null one last, and of its copies any one. No text that stands alone is lost."""
    ready(docs.sparkSession)
    taken = [c for c in docs.columns if c.lower() == "row"]
    rows = numbered(docs.withColumnsRenamed({c: f"kept_{c}" for c in taken}))
    chosen = grouped(rows, similarity, **options).select(F.col("first").alias("row")).distinct()
    back = rows.join(chosen, "row", "left_semi")
    return back.drop("row").withColumnsRenamed({f"kept_{c}": c for c in taken}).select(*docs.columns)
