"""N-gram Jaccard join by chosen paths.

A document is the set of its shingles, ``WORDS`` consecutive words each (words: what lies between ASCII
white space, unchanged; a text of fewer words is one shingle). Two documents are linked when the Jaccard
similarity of their sets is ``SIMILARITY`` or more.

Equal sets are one vertex, the smallest doc_id among them. A run is a recursion of splits: at a node, a set
goes on to the child of each of its shingles whose hash under that node is below ``BRANCHES / (SIMILARITY * size)``, so
sets that are alike choose shared shingles. A child of ``SMALL`` sets or fewer is compared by brute force;
larger ones split further, ``DEPTH`` times at most, and what is large then is compared in blocks, as is at once a
node whose sets are alike on average, for splits would copy such a group rather than part it. A pair at
the threshold goes astray in one run with a probability of about 0.2 at most, however deep (a branching process with two
shared children a node); ``RUNS`` runs, each with hashes of its own, reach the target recall.

Inside a node, pairs are first judged by 128 one-byte minima of their sets, loosely; documents with a
likely partner bring their whole texts, and the exact similarity decides. A pair is judged in the smallest node it
shares, so each counts once; tasks hand on counts and spanning links, never pairs. Texts of documents without
a likely partner are not shuffled.

Null and empty texts (no words) link with nothing, nor do rows with a null doc_id (class null). Rows with equal doc_id are
one vertex where their sets are equal and linked by their id otherwise. Very long texts are sets of bounded
size each and are held one slice at a time. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkspark.llm.common import documents, narrowed, stored
from chunkspark.llm.count_filter import Shared, shared_keys
from chunkspark.llm.pairing import LINKS_DDL, blocked, components, first_pairs, key_table, linked, whole_groups
from chunkspark.llm.repeats import Words
from chunkspark.llm.runs import Fingerprints, mixed
from chunkspark.plans.registry import query

WORDS, SIMILARITY = 5, 0.8
BRANCHES, RECALL = 2.0, 0.999
#: Chance that a pair at the threshold is lost in one run: the smaller root of q = exp(BRANCHES * (q - 1)).
LOST = 0.2032
RUNS = math.ceil(math.log(1 - RECALL) / math.log(LOST))
SMALL, DEPTH, BLOCK = 128, 5, 768
#: A larger node is compared in blocks at once when DRAWN of its members, by hash, are this alike on average: two such
#: sets share more than one of their children, so further splits would multiply the group instead of parting it.
DENSE, DRAWN = 0.35, 64
#: Groups of more sets are intersected by a matrix product, so many shingles at a time.
MANY, COLUMNS = 24, 1024
MINIMA, LIKELY = 128, 0.6
NODE_BITS, DOC_BITS = 24, 24
#: Groups are taken up to so many bytes of text at once.
GROUP_BYTES = 16 << 20


def shingles(text: bytes, known: Words, words: int = WORDS) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending."""
    parts = text.split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    values = np.frombuffer(b"".join([known[w] for w in parts]), dtype="<u8")[::2]
    count = max(1, len(parts) - words + 1)
    prints = Fingerprints(np.ascontiguousarray(values), 0)
    start = np.arange(count)
    return np.unique(prints.of(start, np.minimum(start + words, len(parts))))


def minima(tokens: np.ndarray) -> np.ndarray:
    """One byte for the smallest shingle of each of MINIMA equal ranges, 0 where there is none."""
    out = np.zeros(MINIMA, dtype=np.uint8)
    cell = (tokens >> np.uint64(57)).astype(np.int64)
    names, first = np.unique(cell, return_index=True)
    out[names] = (mixed(tokens[first]) % np.uint64(255)).astype(np.uint8) + 1
    return out


def children(tokens: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Nodes that a set goes on to from ``nodes``."""
    limit = min(1.0, BRANCHES / (SIMILARITY * len(tokens)))
    limit = np.uint64(min(int(limit * 2.0**64), (1 << 64) - 1))
    step, out = max(1, (1 << 19) // len(tokens)), []
    for at in range(0, len(nodes), step):
        some = nodes[at: at + step]
        row, col = np.nonzero(mixed(tokens[None, :] ^ some[:, None]) <= limit)
        out.append(mixed(tokens[col] + mixed(some)[row] * np.uint64(3)))
    return np.unique(np.concatenate(out)) if out else nodes


def _nodes(tokens: np.ndarray, split: list[Shared]) -> np.ndarray:
    """Nodes of a set at depth ``len(split) + 1``, below the large nodes that ``split`` lists by depth."""
    now = children(tokens, mixed(np.arange(1, RUNS + 1, dtype=np.uint64)))
    for large in split:
        now = now[large.test(now)]
        if not len(now):
            return now
        now = children(tokens, now)
    return now


def sets_of(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, set key (k1, k2), size, minima and the nodes of the first depth."""
    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("size", pa.int32()), ("minima", pa.binary()), ("nodes", pa.list_(pa.int64()))])

    def run(batches):
        known = Words()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                tokens = shingles(text.as_py(), known, words)
                if len(tokens):
                    key = (int(tokens.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mixed(tokens)).view(np.int64)))
                    rows.append((doc_id, *key, len(tokens), minima(tokens).tobytes(), _nodes(tokens, []).view(np.int64)))
                else:
                    rows.append((doc_id, 0, 0, 0, b"", []))
            if rows:
                yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.mapInArrow(run, "doc_id long, k1 long, k2 long, size int, minima binary, nodes array<long>")


def deeper(docs: DataFrame, holders: Shared, split: list[Shared], words: int = WORDS) -> DataFrame:
    """(doc_id, node) one depth further for the documents in large nodes, where a node may hold several sets.

    Most children of texts that share little hold one set, so children are counted first, in a sketch, and only those
    that may be shared are named: a second look at the texts of large nodes instead of a table of all children.
    """
    known = Words()

    def named(batch):
        batch = batch.filter(batch.column("doc_id").is_valid())
        batch = batch.filter(pa.array(holders.test(np.asarray(batch.column("doc_id"), dtype=np.int64).view(np.uint64))))
        for doc_id, text in zip(batch.column("doc_id").to_numpy(), batch.column("text")):
            tokens = shingles(text.as_py(), known, words)
            yield doc_id, _nodes(tokens, split) if len(tokens) else tokens

    shared = shared_keys(docs, lambda batch: (nodes for _, nodes in named(batch)), NODE_BITS)

    def run(batches):
        for batch in batches:
            found = [(doc_id, nodes[shared.test(nodes)]) for doc_id, nodes in named(batch)]
            if found:
                ids = np.repeat([doc_id for doc_id, _ in found], [len(nodes) for _, nodes in found])
                yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "node": pa.array(np.concatenate([nodes for _, nodes in found]).view(np.int64))})

    return docs.mapInArrow(run, "doc_id long, node long")


def _keys(column: str):
    def keys(batch):
        yield np.asarray(batch.column(column), dtype=np.int64).view(np.uint64)

    return keys


def _dense(batches):
    """Nodes whose drawn members are alike on average: splitting would not part them."""
    for group, starts in whole_groups(batches, ("node",)):
        marks = np.frombuffer(b"".join(group.column("minima").to_pylist()), dtype=np.uint8).reshape(-1, MINIMA)
        nodes, out = group.column("node").to_numpy(), []
        for a, b in zip(starts[:-1], starts[1:]):
            i, j = np.triu_indices(b - a, 1)
            if len(i) and _alike(marks[a:b], i, j).mean() >= DENSE:
                out.append(nodes[a])
        if out:
            yield pa.record_batch({"node": pa.array(out, pa.int64())})


def _alike(marks: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Estimated similarity of pairs from their minima."""
    out = np.zeros(len(i))
    for at in range(0, len(i), 1 << 14):
        a, b = marks[i[at: at + (1 << 14)]], marks[j[at: at + (1 << 14)]]
        out[at: at + (1 << 14)] = ((a == b) & (a > 0)).sum(axis=1) / np.maximum(1, ((a > 0) | (b > 0)).sum(axis=1))
    return out


def buckets(docs: DataFrame, vertices: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, node) of the nodes in which sets are compared; ``vertices`` has doc_id, minima and first nodes."""
    now = vertices.select("doc_id", F.explode("nodes").alias("node"))
    split, out = [], None
    for depth in range(DEPTH):
        now = stored(now, "nodes")
        sizes = now.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        large = stored(sizes.filter(F.col("n") > SMALL).select("node"), "large")
        last = depth == DEPTH - 1 or large.isEmpty()
        whole = sizes.select("node")
        if not last:
            turn = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("doc_id"), "doc_id"))
            drawn = now.join(large, "node").withColumn("_turn", turn).filter(F.col("_turn") <= DRAWN).drop("_turn")
            drawn = drawn.join(vertices.select("doc_id", "minima"), "doc_id").select("node", "minima")
            dense = stored(drawn.repartition("node").sortWithinPartitions("node").mapInArrow(_dense, "node long"), "dense")
            large = stored(large.join(dense, "node", "left_anti"), "sparse")
            last = large.isEmpty()
            whole = sizes.filter(F.col("n") <= SMALL).select("node").unionByName(dense)
        part = now.join(whole, "node").select("doc_id", "node")
        out = part if out is None else out.unionByName(part)
        if last:
            break
        split.append(shared_keys(large, _keys("node"), NODE_BITS, times=2))
        holders = shared_keys(now.join(large, "node", "left_semi").select("doc_id").distinct(), _keys("doc_id"), DOC_BITS, times=2)
        now = deeper(docs, holders, list(split), words).join(vertices.select("doc_id"), "doc_id", "left_semi")
    # A node may be listed at two depths where a filter let it pass.
    return out.distinct()


def _candidates(group: pa.Table, starts: np.ndarray, marks: np.ndarray):
    """Pairs of a table of groups that may be alike and are judged in this node."""
    own, size = group.column("_own").to_numpy(), group.column("size").to_numpy().astype(np.int64)
    across = group.column("_a").to_numpy() != group.column("_b").to_numpy()
    here, keys, vertex = group.column("node").to_numpy(), key_table(group.column("all_nodes")), group.column("doc_id").to_numpy()
    for i, j in first_pairs(starts, keys, here):
        low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
        kept = (low >= SIMILARITY * high - 1e-9) & ~(across[i] & (own[i] == own[j])) & (vertex[i] != vertex[j])
        i, j = i[kept], j[kept]
        if len(i):
            near = _alike(marks, i, j) >= LIKELY
            yield i[near], j[near]


def _likely(batches):
    """Rows of documents with a partner that their minima make likely, without the minima."""
    for group, starts in whole_groups(batches, ("node", "_a", "_b")):
        marks = np.frombuffer(b"".join(group.column("minima").to_pylist()), dtype=np.uint8).reshape(-1, MINIMA)
        hit = np.zeros(group.num_rows, dtype=bool)
        for i, j in _candidates(group, starts, marks):
            hit[i] = True
            hit[j] = True
        if hit.any():
            yield from group.drop_columns(["minima"]).filter(pa.array(hit)).to_batches()


def _verified(words: int):
    def run(batches):
        known = Words()
        for group, starts in whole_groups(batches, ("node", "_a", "_b")):
            bytes_ = np.cumsum([0, *pc.binary_length(group.column("text")).to_pylist()])
            # Some whole groups at a time, so that only their sets are held.
            at = 0
            while at < len(starts) - 1:
                stop = at + 1
                while stop < len(starts) - 1 and bytes_[starts[stop + 1]] - bytes_[starts[at]] <= GROUP_BYTES:
                    stop += 1
                part = group.slice(int(starts[at]), int(starts[stop] - starts[at])).combine_chunks()
                yield from _exact(part, starts[at: stop + 1] - starts[at], known, words)
                at = stop

    return run


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets with each other, from shingles that two sets have at least."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    names, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    row, at = row[shared[at]], column[at[shared[at]]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for low in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(at, [low, low + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        held[row[a:b], at[a:b] - low] = 1
        out += held @ held.T
    return out


def _exact(group: pa.Table, starts: np.ndarray, known: Words, words: int) -> Iterator[pa.RecordBatch]:
    vertex, weight = group.column("doc_id").to_numpy(), group.column("weight").to_numpy()
    texts = group.column("text")
    marks = np.zeros((group.num_rows, MINIMA), dtype=np.uint8)
    sets: list[np.ndarray] = []
    held: dict[int, int] = {}
    for row, v in enumerate(vertex.tolist()):
        same = held.setdefault(v, row)
        sets.append(sets[same] if same < row else shingles(texts[row].as_py(), known, words))
        if len(sets[row]):
            marks[row] = marks[same] if same < row else minima(sets[row])
    sizes = np.array([len(s) for s in sets])
    common: dict[int, np.ndarray] = {}
    for i, j in _candidates(group, starts, marks):
        both = np.zeros(len(i), dtype=np.int64)
        which = np.searchsorted(starts, i, side="right") - 1
        for g in np.unique(which):
            at, first = np.flatnonzero(which == g), int(starts[g])
            if starts[g + 1] - first > MANY:
                if g not in common:
                    common = {g: _common(sets[first: starts[g + 1]])}
                both[at] = common[g][i[at] - first, j[at] - first]
                continue
            for k in at.tolist():
                x, y = sorted((sets[i[k]], sets[j[k]]), key=len)
                both[k] = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x) if len(x) else 0
        alike = (both > 0) & (both >= SIMILARITY * (sizes[i] + sizes[j] - both) - 1e-9)
        if alike.any():
            yield linked(i[alike], j[alike], vertex, weight)


def jaccard_classes(docs: DataFrame, words: int = WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id reached by links) and n_links."""
    rows = narrowed(docs, doc_id, text)
    members = stored(sets_of(rows, words), "sets")
    usable = members.filter(F.col("doc_id").isNotNull() & (F.col("size") > 0))
    classes = usable.groupBy("k1", "k2", "size").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    classes = stored(classes, "set-classes")
    # A doc_id that stands for several texts is one vertex, by any of its sets.
    vertices = stored(
        usable.join(classes.withColumnRenamed("rep", "doc_id"), ["k1", "k2", "size", "doc_id"])
        .dropDuplicates(["doc_id", "k1", "k2"]).select("doc_id", "size", "minima", "nodes", "weight"), "vertices")
    met = stored(buckets(rows, vertices, words), "buckets")
    lists = met.groupBy("doc_id").agg(F.sort_array(F.collect_list("node")).alias("all_nodes"))
    placed = blocked(met.join(lists, "doc_id").join(vertices.drop("nodes"), "doc_id"), "node", "doc_id", BLOCK)
    placed = placed.select("node", "_a", "_b", "_own", "doc_id", "size", "weight", "all_nodes", "minima")
    likely = stored(placed.mapInArrow(_likely, placed.drop("minima").schema), "likely")
    holders = shared_keys(likely.select("doc_id").distinct(), _keys("doc_id"), DOC_BITS, times=2)

    def of_holders(batches):
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            yield batch.filter(pa.array(holders.test(np.asarray(batch.column("doc_id"), dtype=np.int64).view(np.uint64))))

    texts = rows.mapInArrow(of_holders, rows.schema)
    told = likely.join(texts, "doc_id").repartition("node", "_a", "_b").sortWithinPartitions("node", "_a", "_b", "doc_id")
    links = stored(told.mapInArrow(_verified(words), LINKS_DDL), "links")
    counts = links.groupBy("vertex").agg(F.sum("links").alias("links"))
    groups = components(links.select("vertex", "root"))
    judged = (
        classes.join(counts, F.col("rep") == counts["vertex"], "left").drop("vertex")
        .join(groups, F.col("rep") == groups["vertex"], "left").drop("vertex")
        .select("k1", "k2", "size", F.coalesce("component", "rep").alias("class_id"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    keyed = members.select("doc_id", "k1", "k2", F.when(F.col("doc_id").isNotNull() & (F.col("size") > 0), F.col("size")).alias("size"))
    return keyed.join(judged, ["k1", "k2", "size"], "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


@query("op7_ngram_jaccard_join")
def op7_ngram_jaccard_join(spark, sf_dir):
    return jaccard_classes(documents(spark, sf_dir))
