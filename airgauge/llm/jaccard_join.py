"""N-gram Jaccard join by vertical partitioning.

Word 5-grams have one global order: by how many documents hold them (in powers of two), then by hash; it
comes from a count over the whole corpus. A link at 75 % needs as much of each set in common, so documents
of which less than that is held elsewhere are out, and two linked documents share an n-gram in the heads of
their ordered sets. For the pairs that do, the order is cut into fragments; overlaps are counted in each
fragment apart and summed per pair.

Equal sets are one class. A document is first compared with the most typical document it shares a head
n-gram with; after that only documents that are not yet in one component are. That keeps a group of
thousands of near copies linear, and leaves out no pair that could join two components. `all_links` instead
compares every two classes that share a head n-gram, and gives the pairs and the numbers of links.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgauge.llm import buckets
from airgauge.llm.common import stored, texts_of
from airgauge.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
PERCENT = 75
FRAGMENTS = 8
CHUNK_PAIRS = 20_000  # pairs whose documents one task holds a fragment of
COMPARED = 200  # comparisons a head n-gram may cost on average before pairs are narrowed down once more
LOWER = bytes(range(256)).translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
CHARS_PER_KEY = 6.5
ABOUT = "<q?"  # what follows a set's digest: the document's id, and whether it has one


def word_hashes(text: str) -> np.ndarray:
    # bytes.split() cuts at just the six white-space characters
    words = text.encode().translate(LOWER).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """The sorted hashes of the distinct n-word shingles; of the whole sequence if it is shorter."""
    words = word_hashes(text)
    if not len(words):
        return words
    return np.unique(buckets.window_keys(words, min(n, len(words))))


def _sent_sets(docs: DataFrame, bits: int, text: str) -> DataFrame:
    """Shingles of all documents to their buckets, and once the size and a digest of each set."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in texts_of(batch, text):
                ids = batch.column("uid").slice(first, len(texts)).to_numpy()
                named = batch.column("doc_id").slice(first, len(texts)).to_pylist()
                sets = [shingles(t) for t in texts]
                sizes = np.array([len(s) for s in sets], np.int64)
                owner = np.repeat(np.arange(len(sets)), sizes)
                rows = list(buckets.sent(ids, owner, np.concatenate(sets), bits))
                about = {
                    "bucket": int(ids[0]) % (1 << bits),
                    "top": None,
                    "docs": buckets._packed(np.diff(ids, prepend=0)),
                    "sizes": buckets._packed(sizes.astype("<u4")),
                    "keys": None,
                    "extra": b"".join(xxhash.xxh3_128_digest(s.tobytes()) + struct.pack(ABOUT, i or 0, i is not None) for s, i in zip(sets, named)),
                }
                yield pa.RecordBatch.from_pylist([*rows, about], schema=buckets.SENT_ARROW)

    return docs.select("uid", "doc_id", text).mapInArrow(send, buckets.SENT)


def _counted(table: pa.Table) -> pa.Table:
    """In one bucket: the n-grams that two or more documents hold, back to their documents with their class of frequency."""
    about = table.filter(pa.compute.is_null(table["keys"]))
    docs, keys, _ = buckets.received(table.filter(pa.compute.is_valid(table["keys"])))
    _, counts = buckets.run_lengths(keys)
    shared = np.flatnonzero(counts > 1)
    own = docs[shared]
    cuts = np.concatenate([np.flatnonzero(np.diff(own, prepend=own[:1] - 1)), [len(own)]]) if len(own) else np.zeros(1, np.int64)
    out = [
        pa.table({
            "uid": pa.array(own[cuts[:-1]], pa.int64()),
            "doc_id": pa.nulls(len(cuts) - 1, pa.int64()),
            "n": pa.nulls(len(cuts) - 1, pa.int64()),
            "digest": pa.nulls(len(cuts) - 1, pa.binary()),
            "keys": buckets.blobs(cuts, keys[shared]),
            "often": buckets.blobs(cuts, np.log2(counts[shared]).astype(np.uint8)),
        })
    ]
    for row in about.to_pylist():
        ids, sizes = np.cumsum(buckets._unpacked(row["docs"], "<i8")), buckets._unpacked(row["sizes"], "<u4")
        step = 16 + struct.calcsize(ABOUT)
        cells = [row["extra"][i : i + step] for i in range(0, len(row["extra"]), step)]
        named = [i if known else None for i, known in (struct.unpack_from(ABOUT, c, 16) for c in cells)]
        none = pa.nulls(len(ids), pa.binary())
        out.append(
            pa.table({
                "uid": pa.array(ids), "doc_id": pa.array(named, pa.int64()), "n": pa.array(sizes, pa.int64()),
                "digest": pa.array([c[:16] for c in cells], pa.binary()), "keys": none, "often": none,
            })
        )
    return pa.concat_tables(out)


def _sets(docs: DataFrame, text: str) -> DataFrame:
    """uid, n, digest, held (n-grams that others hold too) and, where they suffice for a link, those n-grams in global order."""
    bits = buckets.bucket_bits(buckets.chars_of(docs, text), CHARS_PER_KEY)
    counted = _sent_sets(docs, bits, text).groupBy("bucket").applyInArrow(_counted, "uid bigint, doc_id bigint, n bigint, digest binary, keys binary, often binary")
    whole = counted.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("digest").alias("digest"),
        F.coalesce(F.sum(F.length("keys")), F.lit(0)).alias("bytes"),
        F.collect_list(F.struct("keys", "often")).alias("parts"),
    )
    held = F.col("bytes") / 8
    enough = (F.col("n") > 0) & (100 * held >= PERCENT * F.col("n"))
    whole = whole.select("uid", "doc_id", "n", "digest", held.cast("bigint").alias("held"), F.when(enough, F.col("parts")).alias("parts"))
    return stored(whole.mapInArrow(_ordered, "uid bigint, doc_id bigint, n bigint, digest binary, held bigint, grams binary, often binary"), "sets")


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams: list[bytes | None] = []
        often: list[bytes | None] = []
        for parts in batch.column("parts"):
            if not parts.is_valid:
                grams.append(None)
                often.append(None)
                continue
            cells = [c for c in parts.as_py() if c["keys"] is not None]
            keys = np.frombuffer(b"".join(c["keys"] for c in cells), "<u8")
            kind = np.frombuffer(b"".join(c["often"] for c in cells), np.uint8)
            order = np.lexsort((keys, kind))
            grams.append(keys[order].tobytes())
            often.append(kind[order].tobytes())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("uid", "doc_id", "n", "digest", "held")), pa.array(grams, pa.binary()), pa.array(often, pa.binary())],
            names=["uid", "doc_id", "n", "digest", "held", "grams", "often"],
        )


def _heads(sets: DataFrame) -> DataFrame:
    """The head of each ordered set: what two linked documents share an n-gram of.

    gram, uid, n, lone (n-grams no other document holds), room (n-grams from this one on that others hold).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, held = (batch.column(c).to_numpy() for c in ("n", "held"))
            # n-grams that no other document holds come first in the order and link nothing
            size = n - -(-PERCENT * n // 100) + 1 - (n - held)
            grams = [np.frombuffer(g, "<i8", s) for g, s in zip(batch.column("grams").to_pylist(), size.tolist())]
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(grams)), *(pa.array(np.repeat(x, size)) for x in (batch.column("uid").to_numpy(), n, n - held)),
                 pa.array(np.repeat(held, size) - place)],
                names=["gram", "uid", "n", "lone", "room"],
            )

    rows = sets.select("uid", "n", "held", "grams").mapInArrow(cut, "gram bigint, uid bigint, n bigint, lone bigint, room bigint")
    shared = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("gram")
    return stored(rows.join(shared, "gram"), "heads")


def _borders(sets: DataFrame, fragments: int) -> np.ndarray:
    """Cuts of the global order into fragments of about equal weight, from a histogram of 64 x 256 cells."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 14, np.int64)
        for batch in batches:
            for g, o in zip(batch.column("grams").to_pylist(), batch.column("often").to_pylist()):
                total += np.bincount(_cell(np.frombuffer(g, "<u8"), np.frombuffer(o, np.uint8)), minlength=1 << 14)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    rows = sets.select("grams", "often").mapInArrow(weigh, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    weight = np.zeros(1 << 14, np.int64)
    for r in rows:
        weight[r.cell] = r.n
    share = np.cumsum(weight) / max(1, weight.sum())
    return np.searchsorted(share, np.arange(1, fragments) / fragments)


def _cell(grams: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Place in the global order: the class of frequency, then the top of the hash."""
    return (np.minimum(often, 63).astype(np.int64) << 8) | (grams >> np.uint64(54) & np.uint64(255)).astype(np.int64)


def _fragments(sets: DataFrame, fragments: int = FRAGMENTS) -> DataFrame:
    """uid, fragment, grams: each ordered set cut at the borders of the fragments."""
    borders = _borders(sets, fragments)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, parts, cells = [], [], []
            for uid, g, o in zip(*(batch.column(c).to_pylist() for c in ("uid", "grams", "often"))):
                grams = np.frombuffer(g, "<u8")
                part = np.searchsorted(borders, _cell(grams, np.frombuffer(o, np.uint8)), side="left")
                for p in np.unique(part).tolist():
                    uids.append(uid)
                    parts.append(p)
                    cells.append(np.sort(grams[part == p]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids, pa.int64()), pa.array(parts, pa.int32()), pa.array(cells, pa.binary())], names=["uid", "fragment", "grams"]
            )

    return stored(sets.select("uid", "grams", "often").mapInArrow(cut, "uid bigint, fragment int, grams binary"), "fragments")


def _overlaps(table: pa.Table) -> pa.Table:
    """In one chunk of pairs and one fragment: what each pair has in common there."""
    held = table.filter(pa.compute.is_valid(table["grams"]))
    cells = {u: np.frombuffer(g, "<u8") for u, g in zip(held["uid"].to_pylist(), held["grams"].to_pylist())}
    none = np.zeros(0, np.uint64)
    pairs = table.filter(pa.compute.is_valid(table["a"]))
    common = []
    for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()):
        x, y = cells.get(a, none), cells.get(b, none)
        if len(x) > len(y):
            x, y = y, x
        if len(x):
            at = np.searchsorted(y, x)
            common.append(int((y[np.minimum(at, len(y) - 1)] == x).sum()))
        else:
            common.append(0)
    return pa.table({"a": pairs["a"], "b": pairs["b"], "na": pairs["na"], "nb": pairs["nb"], "common": pa.array(common, pa.int64())})


def _linked(pairs: DataFrame, fragments: DataFrame, parts: int = FRAGMENTS) -> DataFrame:
    """Of the pairs (a, b, na, nb), those whose sets are similar enough. `b` may stand in very many pairs."""
    n = pairs.count()
    chunks = max(1, n // CHUNK_PAIRS, min(64, n // 500))
    often = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("_deg"))
    share = F.pmod(F.xxhash64("a"), F.ceil(F.col("_deg") / CHUNK_PAIRS))
    placed = pairs.join(often, "b").withColumn("chunk", F.pmod(F.xxhash64("b", share), F.lit(chunks))).drop("_deg")
    asked = placed.select("chunk", F.col("a").alias("uid")).unionByName(placed.select("chunk", F.col("b").alias("uid"))).distinct()
    null = F.lit(None).cast("bigint")
    sent = asked.join(fragments, "uid").select("chunk", "fragment", "uid", "grams", *(null.alias(c) for c in ("a", "b", "na", "nb")))
    every = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("fragment"))
    listed = every.select("chunk", "fragment", null.alias("uid"), F.lit(None).cast("binary").alias("grams"), "a", "b", "na", "nb")
    partial = sent.unionByName(listed).groupBy("chunk", "fragment").applyInArrow(_overlaps, "a bigint, b bigint, na bigint, nb bigint, common bigint")
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    union = F.col("na") + F.col("nb") - F.col("common")
    return stored(total.where(100 * F.col("common") >= PERCENT * union).select("a", "b"), "linked")


def _fits(na: str, room_a: str, nb: str, room_b: str) -> Column:
    """Whether two sets can be similar enough if this is the first n-gram they share: all others come after it.

    A pair that cannot be is refused at its first shared n-gram as at the later ones, so none is lost.
    """
    most = F.least(F.col(room_a), F.col(room_b))
    return 100 * most >= PERCENT * (F.col(na) + F.col(nb) - most)


def _class_links(sets: DataFrame) -> DataFrame:
    """Links (a, b) between classes that give all components; pairs inside a component may be missing."""
    heads = _heads(sets)
    fragments = _fragments(sets)
    # each document with the most typical one of those it shares a head n-gram with: fewest n-grams of its own
    first = heads.groupBy("gram").agg(F.min(F.struct("lone", "uid", "n", "room")).alias("h"))
    near = heads.join(first, "gram").where((F.col("h.uid") != F.col("uid")) & _fits("n", "room", "h.n", "h.room"))
    best = near.groupBy("uid", "n").agg(F.min("h").alias("h"))
    pairs = stored(best.select(F.col("uid").alias("a"), F.col("h.uid").alias("b"), F.col("n").alias("na"), F.col("h.n").alias("nb")), "pairs")
    tried, links = pairs.select("a", "b"), _linked(pairs, fragments)
    n_heads = heads.count()
    for turn in range(4):
        roots = components(links)
        rows = heads.join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
        by = rows.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("lone", "uid", "n", "room")).alias("h"))
        main = by.groupBy("gram").agg(
            F.max(F.struct("c", "root", "h")).alias("m"), F.sum("c").alias("size"), F.count(F.lit(1)).alias("roots")
        ).where("roots > 1")
        open_rows = stored(rows.join(main.select("gram", "m", "size"), "gram"), "open")
        minor = open_rows.where(F.col("root") != F.col("m.root"))
        cost = minor.agg(F.sum("size")).first()[0] or 0
        if not cost:
            break
        last = turn == 3 or cost <= COMPARED * n_heads
        if last:  # every two documents in different components that share a head n-gram
            r = open_rows.select("gram", F.col("uid").alias("_b"), F.col("n").alias("_nb"), F.col("room").alias("_room"), F.col("root").alias("_root"))
            new = minor.join(r, "gram").where((F.col("root") != F.col("_root")) & _fits("n", "room", "_nb", "_room"))
            new = new.select(F.col("uid").alias("a"), F.col("_b").alias("b"), F.col("n").alias("na"), F.col("_nb").alias("nb"))
        else:  # first the most typical document of the largest component there
            new = minor.where(_fits("n", "room", "m.h.n", "m.h.room"))
            new = new.select(F.col("uid").alias("a"), F.col("m.h.uid").alias("b"), F.col("n").alias("na"), F.col("m.h.n").alias("nb"))
        swap = F.col("a") < F.col("b")
        ordered = [F.when(swap, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (("b", "a", "a"), ("a", "b", "b"), ("nb", "na", "na"), ("na", "nb", "nb"))]
        past = tried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        pairs = stored(new.select(*ordered).distinct().join(past, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            links = links.unionByName(_linked(pairs, fragments))
            tried = tried.unionByName(pairs.select("a", "b"))
        if last:
            break
    return links


def _all_class_links(sets: DataFrame) -> DataFrame:
    """All links (a, b) between classes, each once: whatever shares a head n-gram and can be similar enough is compared."""
    heads = _heads(sets)
    other = heads.select("gram", F.col("uid").alias("b"), F.col("n").alias("nb"), F.col("room").alias("_room"))
    near = heads.join(other, "gram").where((F.col("uid") > F.col("b")) & _fits("n", "room", "nb", "_room"))
    pairs = stored(near.select(F.col("uid").alias("a"), "b", F.col("n").alias("na"), "nb").distinct(), "pairs")
    return _linked(pairs, _fragments(sets))


def _grouped(docs: DataFrame, text: str) -> DataFrame:
    """uid, doc_id, n, class_id, component_id, first (the row that stands for its component) for each row of
    `docs` (uid, doc_id, text)."""
    sets = _sets(docs, text)
    rows = sets.select("uid", "doc_id", "n", "digest", F.col("grams").isNotNull().alias("open"))
    some = rows.where("open")
    # a row without an id stands for others only if none of them has one
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "uid"))
    classes = stored(some.groupBy("digest").agg(F.min("uid").alias("uid"), lead.alias("lead")), "classes")
    links = _class_links(stored(sets.join(classes.select("uid"), "uid"), "class-sets"))
    roots = components(links)
    named = classes.join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    least = named.groupBy("root").agg(F.min("lead").alias("first"))
    named = named.join(least, "root").select("digest", "lead", "first")
    found = some.join(named, "digest").select(
        "uid", "doc_id", "n", F.col("lead.doc_id").alias("class_id"), F.col("first.doc_id").alias("component_id"), (F.col("first.uid") == F.col("uid")).alias("first")
    )
    own = F.col("doc_id")
    alone = rows.where("not open").select("uid", "doc_id", "n", own.alias("class_id"), own.alias("component_id"), F.lit(True).alias("first"))
    return found.unionByName(alone)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, n_shingles, component_id (smallest id reachable by links) and class_id (smallest id with the same set).

    Documents link when their sets of distinct 5-word shingles are 75 % alike; letters A-Z count as a-z. A
    text of fewer words is one shingle; NULL, empty and blank texts have none and link with nothing. Every
    row gives one row: rows with the same id are documents of their own, and a NULL id only stands for its
    component if there is no other. Ids are whole numbers.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    found = _grouped(numbered, "text")
    return found.select(F.col("doc_id").alias(id), F.col("n").alias("n_shingles"), "component_id", "class_id")


def all_links(docs: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Each row's number of links, and the linked pairs of classes of equal sets.

    The first has `id`, n_shingles, class (a number of its own for each set; NULL if the row links with
    nothing) and n_links, the rows it links with, copies included, for each row of `docs`. The second has a and b
    (two classes that link, each pair once), class_a and class_b (their smallest ids) and rows_a and rows_b
    (their sizes). Links are those of `near_duplicates`; their number grows with the square of a group.
    """
    sets = _sets(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text")), "text")
    rows = sets.select("doc_id", "n", "digest", F.col("grams").isNotNull().alias("open"))
    some = sets.where(F.col("grams").isNotNull())
    of = F.min("uid").alias("class"), F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("rows")
    classes = stored(some.groupBy("digest").agg(*of), "classes")
    links = _all_class_links(stored(sets.join(classes.select(F.col("class").alias("uid")), "uid"), "class-sets"))
    side = {x: classes.select(F.col("class").alias(x), F.col("class_id").alias(f"class_{x}"), F.col("rows").alias(f"rows_{x}")) for x in ("a", "b")}
    pairs = stored(links.join(side["a"], "a").join(side["b"], "b").select("a", "b", "class_a", "class_b", "rows_a", "rows_b"), "class-links")
    both = pairs.select(F.col("a").alias("class"), F.col("rows_b").alias("with"))
    both = both.unionByName(pairs.select(F.col("b").alias("class"), F.col("rows_a").alias("with")))
    counts = classes.join(both.groupBy("class").agg(F.sum("with").alias("with")), "class", "left")
    counts = counts.select("digest", "class", (F.coalesce("with", F.lit(0)) + F.col("rows") - 1).alias("n_links"))
    found = rows.where("open").join(counts, "digest").select(F.col("doc_id").alias(id), F.col("n").alias("n_shingles"), "class", "n_links")
    alone = rows.where("not open").select(
        F.col("doc_id").alias(id), F.col("n").alias("n_shingles"), F.lit(None).cast("bigint").alias("class"), F.lit(0).cast("bigint").alias("n_links")
    )
    return found.unionByName(alone), pairs


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` without near copies: of each group that `near_duplicates` finds, the row of the smallest id.

    Rows without any word link with nothing and stay, as do all rows alone in their group. Of rows with the
    same smallest id and text one stays.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = stored(docs.select(F.struct(*columns).alias("row"), F.monotonically_increasing_id().alias("uid")), "numbered")
    found = _grouped(whole.select("uid", F.col("row")[id].cast("bigint").alias("doc_id"), F.col("row")[text].alias("text")), "text")
    return whole.join(found.where("first").select("uid"), "uid").select("row.*")
