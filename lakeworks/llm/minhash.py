"""Near-duplicates by MinHash: banded minima, signature check, exact check, components.

A document's set holds its distinct shingles.  Equal sets are one node.  Many
universal hash functions give each node its minima; bands of minima are bucket
keys.  A bucket is compared in the tasks that hold it, sizes and signatures first,
then the full sets, and gives a spanning forest of its links only: what is
connected already is not tested again, and no bucket is expanded into its pairs.
A bucket too large for one task is dealt into pieces that each meet the same
centres: members outside the bucket's largest component, about 256 at a time, until
the bucket is one component or all its members outside the largest were centres.  So
no pair that could join two components goes untested.  Of buckets with the same
members one is compared.  The first band settles most buckets; the others are only
looked into where they hold several components.  Links become components in one task
while they are few, else by large-star and small-star steps.

With 40 bands of 5 minima a pair at similarity 0.8 shares no bucket with a
probability of 1e-7.

Defined results: null and empty texts have an empty set, are linked with nothing
and kept; a text with fewer words than a shingle is one shingle; rows that
repeat an id are documents of their own, with that id; documents without an id
are not linked, have no component and are kept; empty tables give no rows.  Only
the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.arrays import WORD_BASE, lower_ascii, mix, prefix_sums, slices, spans_hash, text_slices, word_hashes, words
from lakeworks.llm.components import FEW_LINKS, components
from lakeworks.llm.names import unused
from lakeworks.session import cut_lineage, filed_by

WORDS, PERCENT = 2, 80
BANDS, ROWS = 40, 5
#: Estimated similarity below the threshold at which a pair is still tested exactly: six standard deviations.
SLACK = 0.18
#: Text a worker turns into sets at a time, and nodes whose ids may be broadcast.
SLICE_BYTES, BROADCAST_NODES = 1 << 20, 1_000_000
#: Centres of a large bucket in a round, about; members of one piece; shingles that a task compares at once.
CENTRES, PIECE_MEMBERS, TASK_SHINGLES = 256, 1000, 1 << 22
#: First band of each group of bands.
BAND_GROUPS = (0, 1)


def shingle_sets(column: pa.Array, n_words: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text in turn."""
    for _, data, offsets in text_slices(column, SLICE_BYTES):
        data = lower_ascii(data)
        starts, ends, firsts = words(data, offsets)
        sums = prefix_sums(word_hashes(data, starts, ends), WORD_BASE)
        for k in range(len(offsets) - 1):
            first, last = int(firsts[k]), int(firsts[k + 1])
            if last == first:
                yield np.zeros(0, np.uint64)
                continue
            at = np.arange(first, max(last - n_words + 1, first + 1))
            yield np.unique(spans_hash(sums, at, np.minimum(at + n_words, last), WORD_BASE))


def hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of ``n`` universal hash functions on 32 bits."""
    numbers = mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return (numbers[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (numbers[n:] >> np.uint64(32)).astype(np.uint32)


def minima(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray], step: int = 1024) -> np.ndarray:
    """Least value of each hash function over the set."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(family[0]), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(values), step):
        hashed = family[0][:, None] * values[None, k : k + step] + family[1][:, None]
        np.minimum(best, hashed.min(axis=1), out=best)
    return best


def node_of(shingles: np.ndarray) -> int:
    """64-bit name of a set."""
    folded = mix(shingles * np.uint64(0x9E3779B97F4A7C15) + np.uint64(len(shingles)))
    total = np.add.reduce(folded) ^ np.multiply.reduce(mix(folded ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1))
    return int(mix(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def signatures(docs: DataFrame, key: str, text: str, n_words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, node (null for an empty set), bands (64-bit keys), text_hash."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_shingles", pa.int64()),
            ("node", pa.int64()),
            ("bands", pa.list_(pa.int64())),
            ("text_hash", pa.int64()),
        ]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(bands * rows)
        salt = np.arange(1, bands + 1, dtype=np.uint64)
        for batch in slices(batches):
            out: list[list] = [batch.column(0).to_pylist(), [], [], [], batch.column(2).to_pylist()]
            for shingles in shingle_sets(batch.column(1), n_words):
                out[1].append(len(shingles))
                if not len(shingles):
                    out[2].append(None), out[3].append(None)
                    continue
                least = minima(shingles, family)
                keys = mix(salt)
                for part in least.reshape(bands, rows).T:
                    keys = mix(keys ^ (part.astype(np.uint64) + np.uint64(0x9E3779B9)))
                out[2].append(node_of(shingles))
                out[3].append(keys.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    content = F.col(text).cast("string")
    source = docs.select(F.col(key).cast("long").alias("doc_id"), content.alias("text"), F.xxhash64(content).alias("text_hash"))
    return source.mapInArrow(sign, "doc_id long, n_shingles long, node long, bands array<long>, text_hash long")


def _sets_of(docs: DataFrame, key: str, text: str, wanted: DataFrame, n_words: int, n_hashes: int) -> DataFrame:
    """(node, signature, shingles) of the wanted nodes, from the text of one document each; ``wanted`` is (node, rep).

    The signature holds the low bytes of the minima.
    """
    wanted = wanted.withColumnsRenamed({"node": "_node", "rep": "_rep"})
    if wanted.count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = source.join(wanted, F.col("doc_id") == F.col("_rep")).select("_node", "text")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(n_hashes)
        for batch in slices(batches):
            names, signs, sets = [], [], []
            for node, shingles in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), n_words)):
                if len(shingles) and node_of(shingles) == node:  # another row of that id may have another text
                    names.append(node)
                    signs.append((minima(shingles, family) & np.uint32(255)).astype(np.uint8).tobytes())
                    sets.append(shingles.tobytes())
            columns = [pa.array(names, pa.int64()), pa.array(signs, pa.binary()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "signature", "shingles"])

    return rows.mapInArrow(collect, "node long, signature binary, shingles binary").dropDuplicates(["node"])


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have at least that share of their union in common."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    place = np.searchsorted(y, x)
    place[place == len(y)] = 0
    common = int(np.count_nonzero(y[place] == x))
    return 100 * common >= percent * (len(x) + len(y) - common)


def forest(
    component: np.ndarray, signs: np.ndarray, sets: list[np.ndarray], n_centres: int, percent: int
) -> list[tuple[int, int]]:
    """Links (component, component) that join what the tests of a group of nodes can join, none of them twice.

    The first ``n_centres`` nodes are tested against all, or every pair if there are
    none; pairs that are connected by then are not.
    """
    n, label = np.array([len(s) for s in sets]), component.copy()
    least = percent / 100 - SLACK
    found = []
    for c in range(n_centres or len(sets) - 1):
        rest = slice(c + 1, None)
        fits = (label[rest] != label[c]) & (100 * np.minimum(n[rest], n[c]) >= percent * np.maximum(n[rest], n[c]))
        some = np.flatnonzero(fits) + c + 1
        if len(some):
            some = some[(signs[some] == signs[c]).mean(axis=1) >= least]
        for k in some.tolist():
            if label[k] != label[c] and alike(sets[c], sets[k], percent):
                found.append((int(component[c]), int(component[k])))
                label[label == label[k]] = label[c]
    return found


def _links(rows: DataFrame, percent: int, n_hashes: int) -> DataFrame:
    """Confirmed links (a, b) between components, at most one fewer than nodes in each (band, piece); two may give one link.

    ``rows``: band, piece, centre, node, component, signature, shingles.  A
    group is compared in the task that holds it, on the full sets.
    """
    names = ("band", "piece", "centre", "component", "signature", "shingles")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []

        def links() -> list[tuple[int, int]]:
            component = np.array([g[3] for g in group], dtype=np.int64)
            if not (component != component[0]).any():
                return []
            signs = np.frombuffer(b"".join([g[4] for g in group]), np.uint8).reshape(-1, n_hashes)
            sets = [np.frombuffer(g[5], np.uint64) for g in group]
            return forest(component, signs, sets, sum(g[2] for g in group), percent)

        for batch in slices(batches):
            found: list[tuple[int, int]] = []
            for row in zip(*(batch.column(k).to_pylist() for k in names)):
                if group and row[:2] != group[0][:2]:
                    found += links()
                    group = []
                group.append(row)
            pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
        pairs = np.array(links() if group else [], dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    # the order within a group is fixed, so that a task run again gives the same links
    dealt = rows.repartition("band", "piece").sortWithinPartitions("band", "piece", F.desc("centre"), "node")
    return dealt.select(*names).mapInArrow(joined, "a long, b long")


def _centres(large: DataFrame, turn: int) -> DataFrame:
    """Nodes of large buckets outside each one's largest component: all of them (``last``) if they are few, else a share by hash.

    Only partial aggregations touch the buckets, however large.
    """
    sizes = large.groupBy("band", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("band").agg(F.max(F.struct("size", -F.col("component"))).alias("top"))
    most = F.greatest(F.lit(1), F.least(F.lit(CENTRES), F.floor(F.lit(TASK_SHINGLES) * F.col("m") / F.col("total"))))
    shares = F.ceil((F.col("m") - F.col("top.size")) / most)
    return (
        large.join(largest, "band")
        .filter((F.col("component") != -F.col("top.col2")) & (F.pmod(F.xxhash64("node", F.lit(turn)), shares) == 0))
        .select("band", "component", "node", "pieces", (shares == 1).alias("last"))
    )


def _different(buckets: DataFrame) -> DataFrame:
    """Of buckets with the same members only the first band's, as its tests settle the others.

    Members are compared by number, least, greatest and 128 bits of their hashes.
    """
    mark = F.xxhash64("node")
    members = F.struct(
        F.count("*").alias("m"),
        F.min("node").alias("lo"),
        F.max("node").alias("hi"),
        F.bit_xor(mark).alias("marks"),
        F.bit_xor(F.xxhash64(mark)).alias("again"),
    )
    shape = buckets.groupBy("band").agg(F.min("slot").alias("slot"), members.alias("members"))
    first = shape.groupBy("members").agg(F.min(F.struct("slot", "band")).alias("first")).select("first.band")
    return buckets.join(first, "band", "left_semi")


def _labelled(entries: DataFrame, found: DataFrame | None) -> DataFrame:
    """Entries (band, node, n) with the component each node has by now; written where it takes a join, as they are read twice."""
    if found is None:
        return entries.withColumn("component", F.col("node"))
    labels = found.select(F.col("node").alias("_node"), F.col("component").alias("_label"))
    now = entries.join(labels, F.col("node") == F.col("_node"), "left")
    return cut_lineage(now.select("band", "node", "n", F.coalesce("_label", "node").alias("component")), "labelled")


def _open(entries: DataFrame) -> DataFrame:
    """The entries of buckets that hold several components; pieces is 0 for a bucket that one task compares whole."""
    shape = entries.groupBy("band").agg(
        F.count("*").alias("m"),
        F.sum("n").alias("total"),
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
    )
    dealt = F.greatest(F.ceil(F.col("m") / PIECE_MEMBERS), F.ceil(F.col("total") / TASK_SHINGLES)).cast("int")
    whole = (F.col("m") <= PIECE_MEMBERS) & (F.col("total") <= TASK_SHINGLES)
    shape = shape.filter("lo < hi").select("band", "m", "total", F.when(whole, 0).otherwise(dealt).alias("pieces"))
    return entries.join(shape, "band").select("band", "node", "n", "component", "m", "total", "pieces")


def _merged(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (node, component) after links between components; of many only the new links are walked."""
    known = links if found is None else links.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
    if found is None or known.count() <= FEW_LINKS:
        return cut_lineage(components(known), "components")
    joined = cut_lineage(components(links), "merged")
    joined = joined.withColumnsRenamed({"node": "_old", "component": "_new"})
    moved = found.join(joined, F.col("component") == F.col("_old"), "left").select(
        "node", F.coalesce("_new", "component").alias("component")
    )
    fresh = joined.join(found, F.col("_old") == F.col("node"), "left_anti").select(
        F.col("_old").alias("node"), F.col("_new").alias("component")
    )
    return cut_lineage(moved.unionByName(fresh), "components")


def linked(buckets: DataFrame, payload: DataFrame, percent: int, n_hashes: int) -> DataFrame | None:
    """Components (node, component) of the nodes that have links, None without any.

    ``buckets``: slot, band, node, n; ``payload``: node, signature, shingles.
    Bands are taken in groups, as most buckets are one component after the first
    and need no test any more.  The payload should be filed by node, as each turn
    joins it.
    """
    found = None
    for first, last in zip(BAND_GROUPS, (*BAND_GROUPS[1:], None)):
        own = F.col("slot") >= first if last is None else F.col("slot").between(first, last - 1)
        entries = buckets.filter(own).select("band", "node", "n")
        for turn in count():
            now = cut_lineage(_open(_labelled(entries, found)), "open")
            most = now.agg(F.max("pieces")).first()[0]
            if most is None:
                break
            rows = now.select(
                "band",
                F.when(F.col("pieces") > 0, F.pmod(F.xxhash64("node"), F.col("pieces"))).otherwise(0).cast("int").alias("piece"),
                F.lit(False).alias("centre"),
                "node",
                "component",
            )
            if most:
                centres = cut_lineage(_centres(now.filter("pieces > 0"), turn), "centres")
                everywhere = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
                rows = rows.unionByName(
                    centres.select("band", everywhere.alias("piece"), F.lit(True).alias("centre"), "node", "component")
                )
            links = cut_lineage(_links(rows.join(payload, "node"), percent, n_hashes), "links")
            if not links.isEmpty():
                found = _merged(found, links)
            if not most:
                break
            # a centre was tested against its whole bucket; where all outside the largest component were, it is settled
            entries = now.filter("pieces > 0").join(centres.filter("last").select("band"), "band", "left_anti")
            entries = entries.join(centres.select("band", "node"), ["band", "node"], "left_anti").select("band", "node", "n")
    return found


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n_words: int = WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Per document: doc_id, n_shingles, node, component_id (least id reachable), kept, text_hash."""
    signed = cut_lineage(signatures(docs, key, text, n_words, bands, rows), "signed")
    linkable = signed.filter("node is not null and doc_id is not null")
    reps = linkable.groupBy("node").agg(F.min("doc_id").alias("rep"))
    entries = linkable.join(reps.select("node", F.col("rep").alias("doc_id")), ["node", "doc_id"]).select(
        "node", F.col("n_shingles").cast("int").alias("n"), F.posexplode("bands").alias("slot", "band")
    )
    keys = linkable.select("node", F.explode("bands").alias("band"))
    shared = keys.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
    buckets = cut_lineage(entries.join(shared.select("band"), "band").distinct(), "buckets")
    live = cut_lineage(buckets.select("node").distinct().join(reps, "node"), "live")
    buckets = cut_lineage(_different(buckets), "buckets")
    with filed_by(_sets_of(docs, key, text, live, n_words, bands * rows), "node", "sets") as payload:
        found = linked(buckets, payload, percent, bands * rows)
    if found is None:
        named = reps.select("node", F.col("rep").alias("component_id"))
    else:
        grouped = reps.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
        named = grouped.join(least, "component").select("node", "component_id")
    return signed.select("doc_id", "n_shingles", "node", "text_hash").join(named, "node", "left").select(
        "doc_id",
        "n_shingles",
        "node",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("component_id", "doc_id"))).alias("kept"),
        "text_hash",
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group, the one with the least id; all columns unchanged.

    Of rows with equal id and text one stays; of rows with equal id and other
    texts only those go that are near-duplicates themselves.  Documents without an id or
    without a set stay.
    """
    found = near_duplicates(docs, key, text, **options)
    gone_id, gone_text, again_id = unused(docs.columns, "_gone", "_text", "_again")
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_text)).distinct()
    same = (F.col(key) == F.col(gone_id)) & (F.xxhash64(F.col(text).cast("string")) == F.col(gone_text))
    rest = docs.join(gone, same, "left_anti")
    repeated = found.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select(F.col("doc_id").alias(again_id))
    if repeated.isEmpty():
        return rest
    again = F.col(key) == F.col(again_id)
    return rest.join(repeated, again, "left_anti").unionByName(
        rest.join(repeated, again, "left_semi").dropDuplicates([key, text])
    )
