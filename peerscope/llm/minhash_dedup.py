"""Near-duplicates by chosen-path set similarity join on five-word shingles.

A text's set is reduced to ``COORDINATES`` min-hashes; equal sets form one class.  Each of ``TREES`` independent trees
branches a class on two coordinates a node: the coordinates are chosen by the node's path, the child by the class's
min-hash there, so classes of similarity s stay together in a child with probability s.  A node of at most
``SMALL_NODE`` classes is compared exhaustively; a larger one branches on.  Two classes of similarity 0.75 part ways in
all branches of one tree with probability 0.11, in all six trees with 2 in a million.

A large node whose classes are alike (versions of one text), or that is still large at ``DEPTH``, would take all its
pairs to finish.  Its classes form a crowd instead.  The crowd's common shingles P are those of a quarter of a sample
of it; each class is linked to the classes nearest to P, and a class x left outside the main component can then only be
similar to a class y that (i) is short enough for the P-shingles of both to suffice, 7 min(|x∩P|, |y∩P|) >= 3 (|x|+|y|),
or (ii) has a shingle outside P in common with x, which only the rarest of them need to tell.  Both are equality joins, and the two cases are all there are whatever
P is: so a crowd of any size is finished without its pairs, and no link is lost to P.

A large crowd is recognised before the trees: its classes share one of a few min-hashes.  Its core, the classes with
``LEAST_MATCHES`` of the crowd's most frequent min-hashes, stays out of the trees.  Differing min-hashes are a distance, so
whatever has ``LEAST_MATCHES`` in common with a class of the core has ``LEAST_NEAR`` in common with those most frequent ones:
an equality join on min-hashes finds all such classes, and they are members of the crowd too.  All classes outside cores go
through the trees, members of a crowd or not, so no pair of classes is left to chance beyond the trees'.  Below the first two
levels large nodes branch two levels at once.

Candidates are confirmed on the full shingle sets of the texts: first each class's best candidates, then a crowd's strays
against the hubs of its main component, then, in rounds, the most alike few of all pairs that would still join the same two
components; pairs of components that are one by then are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from peerscope.llm.components import connected_components
from peerscope.llm.shared import byte_texts, hidden, mix, stage, table, window_hashes, word_hashes
from peerscope.operators.joins import salted_join

WORDS = 5
PERCENT = 75
COORDINATES = 128
TREES = 6
BRANCHES = 2
DEPTH = 6
SMALL_NODE = 32
ALIKE = 0.4  # mean share of min-hashes that two classes of a large node have in common, from which on it is a crowd
LEAST_MATCHES = 77  # of 128 min-hashes; a similarity of 0.75 falls below with a chance of 1 in 20,000
GROUP_ROWS = 16_384
SAMPLE = 64
CENTRES = 8
HUBS = 32  # classes of a crowd's main component that its strays are held against first
CROWD_CLASSES = 256  # classes with one min-hash, from which on they are looked at as a crowd before the trees
CROWD_COORDINATES = 3
LEAST_NEAR = 2 * LEAST_MATCHES - COORDINATES  # the least a candidate of a core's class has in common with the crowd's most frequent ones
FIRST_TRIES = 4  # pairs of two components confirmed in the first round, four times as many in each further one

_FACTOR = mix(np.arange(COORDINATES, dtype=np.uint64), 21) | np.uint64(1)
_SHIFT = mix(np.arange(COORDINATES, dtype=np.uint64), 22)


def shingle_sets(texts: list[bytes], width: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``width`` are one shingle, none is no shingle."""
    words, first = word_hashes(texts, lower=True)
    every = window_hashes(words, width, 2)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(every[a: b - width + 1]))
        else:
            out.append(window_hashes(words[a:b], b - a, 30 + b - a) if b > a else np.zeros(0, dtype=np.uint64))
    return out


def min_hashes(shingles: np.ndarray) -> bytes:
    """16 bits of each coordinate's min-hash."""
    out = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint64)
    for i in range(0, len(shingles), 4096):
        x = shingles[None, i: i + 4096] * _FACTOR[:, None]
        x += _SHIFT[:, None]
        np.minimum(out, x.min(axis=1) >> np.uint64(32), out=out)
    return out.astype(np.uint16).tobytes()


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, body, n_shingles, set, sig) of every text; ``set`` is 128 bits that equal sets share."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch["text"])
            step = max(1, len(texts) * 4_000_000 // max(1, sum(map(len, texts))))
            for i in range(0, len(texts), step):
                found = shingle_sets(texts[i: i + step])
                part = batch.slice(i, step)
                key = [np.array([mix(s, 23).sum(), mix(s, 24).sum()], dtype=np.uint64).tobytes() for s in found]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["body"], pa.array([len(s) for s in found], pa.int64()), pa.array(key, pa.binary()),
                     pa.array([min_hashes(s) for s in found], pa.binary())],
                    names=["doc_id", "body", "n_shingles", "set", "sig"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("body")) \
        .mapInArrow(sets, f"doc_id {id_type}, body long, n_shingles long, set binary, sig binary")


def _shared_nodes(rows: DataFrame) -> DataFrame:
    """(node, set, n): the rows of nodes with two classes or more, and the node's size."""
    rows = rows.select("node", "set")
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return stage(salted_join(rows, sizes, "node", "set"), "nodes")


def _min_hash(coordinate: Column) -> Column:
    return F.substring("sig", coordinate * 2 + 1, F.lit(2))


def _branch(large: DataFrame) -> DataFrame:
    """The children of large nodes: two further coordinates of each, chosen by the node's path."""
    first, rest = TREES * BRANCHES, COORDINATES - TREES * BRANCHES
    one = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(rest)).cast("int")
    other = F.pmod(one + 1 + F.pmod(F.xxhash64("node", F.lit(2)), F.lit(rest - 1)).cast("int"), F.lit(rest)).cast("int")
    return large.select("set", "sig", F.explode(F.array(*[F.xxhash64("node", c, _min_hash(c + first)) for c in (one, other)])).alias("node"))


def _matches(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Number of equal min-hashes of each pair."""
    x, y = (np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint16).reshape(-1, COORDINATES) for c in (a, b))
    return (x == y).sum(axis=1)


def _alike(pairs: DataFrame) -> DataFrame:
    """(a, b, est) with a < b from (a, b, sig_a, sig_b), if enough min-hashes agree."""
    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            est = _matches(batch["sig_a"], batch["sig_b"])
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(est, pa.int32())], names=["a", "b", "est"]) \
                .filter(pa.array(est >= LEAST_MATCHES))

    found = pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(alike, "a binary, b binary, est int")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "est")


def _matches_of(rows: DataFrame, keep: str) -> DataFrame:
    """(set, keep, est) of rows (set, keep, sig, other): how many min-hashes agree with ``other``."""
    kind = rows.schema[keep].dataType.simpleString()

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["set"], batch[keep], pa.array(_matches(batch["sig"], batch["other"]), pa.int32())],
                                             names=["set", keep, "est"])

    return rows.select("set", keep, "sig", "other").mapInArrow(matches, f"set binary, {keep} {kind}, est int")


def _compared(group: pa.Table) -> pa.Table:
    """(a, b, est): the classes of each small node compared exhaustively; ``group`` holds many nodes."""
    group = group.sort_by([("node", "ascending"), ("set", "ascending")])
    node = group["node"].to_numpy()
    sigs = np.frombuffer(b"".join(group["sig"].to_pylist()), dtype=np.uint16).reshape(-1, COORDINATES)
    starts = np.flatnonzero(np.diff(node, prepend=node[0] - 1))
    left, right, est = [], [], []
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(node)], strict=True):
        x = sigs[start:end]
        equal = (x[:, None, :] == x[None, :, :]).sum(axis=2)
        i, j = np.nonzero(np.triu(equal >= LEAST_MATCHES, 1))
        left.append(i + start)
        right.append(j + start)
        est.append(equal[i, j])
    sets = group["set"].combine_chunks()
    return pa.table({"a": sets.take(pa.array(np.concatenate(left))), "b": sets.take(pa.array(np.concatenate(right))),
                     "est": pa.array(np.concatenate(est), pa.int32())})


def _consensus(group: pa.Table) -> pa.Table:
    """The most frequent min-hash at each coordinate of a bounded sample of a node, and the sample's mean likeness."""
    sigs = np.frombuffer(b"".join(group["sig"].to_pylist()), dtype=np.uint16).reshape(-1, COORDINATES)
    mode = np.array([(v := np.unique(c, return_counts=True))[0][v[1].argmax()] for c in sigs.T], dtype=np.uint16)
    equal = (sigs[:, None, :] == sigs[None, :, :]).mean(axis=2)[np.triu_indices(len(sigs), 1)]
    return pa.table({"node": group["node"].slice(0, 1), "other": pa.array([mode.tobytes()], pa.binary()), "likeness": pa.array([equal.mean()])})


def _sampled(rows: DataFrame, by: str, n: int) -> DataFrame:
    """The ``n`` rows of each ``by`` with the smallest hashes of their set; each task only ships its own smallest."""
    nth = F.row_number().over(W.partitionBy(by).orderBy(F.xxhash64("set"), "set"))
    return rows.withColumn("nth", nth).filter(F.col("nth") <= n).drop("nth")


def _crowded_nodes(large: DataFrame) -> DataFrame:
    """(node, other) of the nodes of (node, set, sig) whose classes are alike, with their most frequent min-hashes."""
    modes = _sampled(large, "node", 16).groupBy("node").applyInArrow(_consensus, "node long, other binary, likeness double")
    return modes.filter(F.col("likeness") >= ALIKE).select("node", "other")


def recognise(sigs: DataFrame) -> DataFrame | None:
    """Staged (crowd, set) of the classes of large crowds, each class once, before any tree; None: there is no such crowd.

    Nearly all versions of one text share its min-hash at any coordinate, and all but a few at one of three.  Groups by
    these min-hashes that have a class in common are one crowd, named by its smallest class.
    """
    coordinates = [F.lit(COORDINATES - 1 - c) for c in range(CROWD_COORDINATES)]
    rows = sigs.select("set", "sig", F.explode(F.array(*[F.xxhash64(c, _min_hash(c)) for c in coordinates])).alias("node"))
    sizes = stage(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWD_CLASSES).select("node"), "frequent")
    if sizes.isEmpty():
        return None
    frequent = salted_join(rows, sizes, "node", "set")
    crowded = stage(_crowded_nodes(frequent).select("node"), "crowded-groups")
    if crowded.isEmpty():
        return None
    of_class = salted_join(frequent.select("node", "set"), crowded, "node", "set").groupBy("set").agg(F.sort_array(F.collect_set("node")).alias("nodes"))
    of_class = stage(of_class, "recognised")
    together = of_class.select(F.col("nodes")[0].alias("a"), F.explode("nodes").alias("b")).distinct()
    roots = connected_components(together)
    first = of_class.select("set", F.col("nodes")[0].alias("node"))
    named = salted_join(first, roots, "node", "set", "left").select("set", F.coalesce("root", "node").alias("root"))
    names = named.groupBy("root").agg(F.min("set").alias("crowd"))
    return stage(salted_join(named, names, "root", "set").select("crowd", "set"), "crowd-members")


def _modes(known: DataFrame, sigs: DataFrame) -> DataFrame:
    """Staged (crowd, other): the most frequent min-hashes of a sample of each crowd."""
    sample = _sampled(known, "crowd", SAMPLE).join(sigs, "set").select(F.col("crowd").alias("node"), "sig")
    modes = sample.groupBy("node").applyInArrow(_consensus, "node binary, other binary, likeness double")
    return stage(modes.select(F.col("node").alias("crowd"), "other"), "crowd-modes")


def _meeting(rows: DataFrame, modes: DataFrame) -> DataFrame:
    """(crowd, set, est) of the (set, sig, own) with ``LEAST_NEAR`` of the most frequent min-hashes of a crowd not their own."""
    key = F.explode(F.array(*[F.xxhash64(F.lit(c), _min_hash(F.lit(c))) for c in range(COORDINATES)]))
    theirs = stage(modes.select("crowd", F.col("other").alias("sig")).select("crowd", key.alias("key")), "mode-keys")
    met = rows.select("set", "own", key.alias("key")).join(theirs, "key").filter(~F.col("crowd").eqNullSafe(F.col("own")))
    return met.groupBy("crowd", "set").agg(F.count(F.lit(1)).cast("int").alias("est")).filter(F.col("est") >= LEAST_NEAR)


def find_candidates(sigs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged (a, b, est) candidates and staged (crowd, set) of all crowds, from (set, sig).

    The core of a crowd recognised beforehand stays out of the trees: all that may be similar to a class of it is a
    member of the crowd.  Of recognised classes that have little in common with their crowd only the trees take care.
    """
    known = recognise(sigs)
    if known is None:
        return grow_trees(sigs)
    modes = _modes(known, sigs)
    alike = _meeting(modes.select(F.col("crowd").alias("set"), F.col("other").alias("sig"), F.col("crowd").alias("own")), modes)
    alike = stage(alike.select(F.col("crowd").alias("a"), F.col("set").alias("b")), "alike-crowds")
    if not alike.isEmpty():  # crowds that meet are one
        names = connected_components(alike).withColumnRenamed("node", "crowd")
        known = stage(salted_join(known, names, "crowd", "set", "left").select(F.coalesce("root", "crowd").alias("crowd"), "set"), "crowd-members")
        modes = _modes(known, sigs)
    placed = stage(sigs.join(known.withColumnRenamed("crowd", "own"), "set", "left").select("set", "sig", "own"), "placed")
    of_own = salted_join(placed.filter("own IS NOT NULL").withColumnRenamed("own", "crowd"), modes, "crowd", "set")
    of_own = _matches_of(of_own, "crowd").filter(F.col("est") >= LEAST_NEAR).select("crowd", "set", "est")
    held = stage(of_own.union(_meeting(placed, modes)), "held")
    core = held.filter(F.col("est") >= LEAST_MATCHES).select("set")
    candidates, crowds = grow_trees(stage(sigs.join(core, "set", "left_anti"), "tree-classes"))
    return candidates, stage(crowds.union(held.select("crowd", "set")).distinct(), "all-crowds")


def grow_trees(sigs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged (a, b, est) candidates of the small nodes, and staged (crowd, set) of the crowds, from (set, sig)."""
    roots = F.array(*[F.xxhash64(F.lit(t), F.lit(c), _min_hash(F.lit(c))) for t in range(TREES) for c in range(t * BRANCHES, (t + 1) * BRANCHES)])
    # the first two levels at once: nearly every class shares some min-hash with strangers, few share two
    rows = _shared_nodes(_branch(sigs.select("set", "sig", F.explode(roots).alias("node"))))
    small, crowds = [], []
    for level in range(2, DEPTH + 1, 2):
        small.append(rows.filter(F.col("n") <= SMALL_NODE).select("node", "set"))
        large = rows.filter(F.col("n") > SMALL_NODE).select("node", "set")
        large = stage(large.join(sigs, "set").select("node", "set", "sig"), "large-nodes")
        if large.isEmpty():
            break
        sample = _sampled(large, "node", 16)
        modes = sample.groupBy("node").applyInArrow(_consensus, "node long, other binary, likeness double")
        if level < DEPTH:
            modes = stage(modes, "modes")
        crowded = modes.filter(F.col("likeness") >= ALIKE) if level < DEPTH else modes
        marked = salted_join(large, crowded.select("node", "other"), "node", "set", how="left")
        crowds.append(marked.filter("other IS NOT NULL"))
        if level < DEPTH:
            rows = _shared_nodes(_branch(_branch(marked.filter("other IS NULL").select("node", "set", "sig"))))  # two levels at once again
    members = _union(small)
    groups = max(1, members.count() // GROUP_ROWS)
    pairs = members.join(sigs, "set").withColumn("part", F.pmod("node", F.lit(groups))) \
        .groupBy("part").applyInArrow(_compared, "a binary, b binary, est int")
    candidates = stage(pairs.distinct(), "candidates")
    crowded = stage(_union(crowds), "crowded") if crowds else None
    if crowded is None or crowded.isEmpty():
        return candidates, candidates.limit(0).select(F.col("a").alias("crowd"), F.col("b").alias("set"))
    # nodes of one crowd in different trees agree on the class nearest to their consensus: it names the crowd
    nearest = _matches_of(crowded, "node").groupBy("node").agg(F.max(F.struct("est", "set"))["set"].alias("crowd"))
    members = stage(salted_join(crowded, nearest, "node", "set").select("crowd", "set").distinct(), "crowds")
    # a crowd that holds another's name, or is held by it, takes the smallest such name: few crowds of one kind are left
    names = members.select("crowd").distinct().withColumnRenamed("crowd", "set")
    held = members.join(names, "set").select("crowd", "set")
    lowest = held.union(held.select("set", "crowd")).toDF("crowd", "name").groupBy("crowd").agg(F.min("name").alias("name"))
    named = salted_join(members, lowest, "crowd", "set")
    return candidates, stage(named.select(F.least("crowd", "name").alias("crowd"), "set").distinct(), "crowds")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.union(df)
    return out


def _common(group: pa.Table) -> pa.Table:
    """The shingles in at least a quarter of a bounded sample of a crowd."""
    sets = shingle_sets(byte_texts(group["text"]))
    every, counts = np.unique(np.concatenate(sets), return_counts=True)
    return pa.table({"crowd": group["crowd"].slice(0, 1), "common": pa.array([every[4 * counts >= len(sets)].tobytes()], pa.binary())})


def profiles(crowds: DataFrame, texts: DataFrame) -> DataFrame:
    """Staged (crowd, set, n, inside, common, extra): of each class its size, its shingles in P, |P| and those outside P."""
    rows = crowds.join(texts, "set").select("crowd", "set", "text")
    common = _sampled(crowds, "crowd", SAMPLE).join(texts, "set").select("crowd", "text") \
        .groupBy("crowd").applyInArrow(_common, "crowd binary, common binary")

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(byte_texts(batch["text"]))
            commons = [np.frombuffer(c, dtype=np.uint64) for c in batch["common"].to_pylist()]
            extra = [np.setdiff1d(s, c, assume_unique=True).view(np.int64) for s, c in zip(sets, commons, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["crowd"], batch["set"], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([len(s) - len(e) for s, e in zip(sets, extra, strict=True)], pa.int64()),
                 pa.array([len(c) for c in commons], pa.int64()), pa.array(extra, pa.list_(pa.int64()))],
                names=["crowd", "set", "n", "inside", "common", "extra"])

    return stage(salted_join(rows, common, "crowd", "set").select("crowd", "set", "text", "common")
                 .mapInArrow(profile, "crowd binary, set binary, n long, inside long, common long, extra array<long>"), "profiles")


def _with_sigs(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(sigs.select(F.col("set").alias(end), F.col("sig").alias(f"sig_{end}")), end)
    return pairs


def _nearest_to_p(members: DataFrame, n: int) -> DataFrame:
    """(crowd, b) of the ``n`` members of each crowd that are nearest to P."""
    near = F.col("inside") / (F.col("n") + F.col("common") - F.col("inside"))
    nth = F.row_number().over(W.partitionBy("crowd").orderBy(near.desc(), "set"))
    return members.select("crowd", "set", "n", "inside", "common").withColumn("nth", nth).filter(F.col("nth") <= n) \
        .select("crowd", F.col("set").alias("b"))


def _best_hubs(asked: DataFrame, hubs: DataFrame, sigs: DataFrame, tries: int) -> DataFrame:
    """(a, b): each asked (crowd, a) with the ``tries`` most alike of its crowd's few hubs (crowd, b).

    A crowd's hubs are packed into one row, so no pair leaves the task but the best.
    """
    packed = hubs.join(sigs.select(F.col("set").alias("b"), "sig"), "b").groupBy("crowd").agg(F.sort_array(F.collect_list(F.struct("b", "sig"))).alias("hubs"))
    rows = asked.select("crowd", F.col("a").alias("set")).join(sigs.select("set", "sig"), "set")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for a, sig, few in zip(*(batch[c].to_pylist() for c in ("set", "sig", "hubs")), strict=True):
                theirs = np.frombuffer(b"".join(h["sig"] for h in few), dtype=np.uint16).reshape(-1, COORDINATES)
                est = (theirs == np.frombuffer(sig, dtype=np.uint16)).sum(axis=1)
                order = [i for i in np.argsort(-est, kind="stable").tolist() if est[i] >= LEAST_MATCHES and few[i]["b"] != a][:tries]
                left += [min(a, few[i]["b"]) for i in order]
                right += [max(a, few[i]["b"]) for i in order]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

    return salted_join(rows, packed, "crowd", "set").select("set", "sig", "hubs").mapInArrow(best, "a binary, b binary").distinct()


def star_pairs(crowd: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b): each class of a crowd with the two most alike of the crowd's classes nearest to P."""
    return _best_hubs(crowd.select("crowd", F.col("set").alias("a")), _nearest_to_p(crowd, CENTRES), sigs, 2)


def _rare_extras(crowd: DataFrame) -> DataFrame:
    """(crowd, set, shingle): enough of each class's shingles outside P, rarest first, to meet whatever it is similar to.

    A similar class shares at least t = 0.75 n - inside of the e shingles outside P (similar sets are no smaller than
    0.75 n), so one of any e - t + 1 of them; a shingle no other class of the crowd has meets nothing and is not listed.
    """
    every = crowd.select("crowd", "set", F.explode("extra").alias("shingle"))
    common = every.groupBy("crowd", "shingle").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    needed = F.greatest(F.lit(1), F.ceil(F.col("n") * (PERCENT / 100) - 1e-6) - F.col("inside"))
    of_set = W.partitionBy("crowd", "set")
    listed = every.join(common, ["crowd", "shingle"]) \
        .withColumn("nth", F.row_number().over(of_set.orderBy("classes", "shingle"))) \
        .withColumn("shared", F.count(F.lit(1)).over(of_set))
    slots = crowd.select("crowd", "set", (F.size("extra") - needed + 1).alias("slots"), F.size("extra").alias("extras"))
    kept = listed.join(slots, ["crowd", "set"]).filter(F.col("nth") <= F.col("slots") - (F.col("extras") - F.col("shared")))
    return stage(kept.select("crowd", "set", "shingle"), "rare")


def _with_roots(crowd: DataFrame, roots: DataFrame) -> DataFrame:
    """Crowd members (crowd, set, n, inside, common) with their component."""
    members = crowd.select("crowd", "set", "n", "inside", "common")
    return members.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))


def strays_of(named: DataFrame) -> DataFrame:
    """Staged (crowd, a, n_a, inside_a, root_a, main) of the classes outside their crowd's main component, the largest."""
    main = named.groupBy("crowd", "root").agg(F.count(F.lit(1)).alias("size")) \
        .groupBy("crowd").agg(F.max(F.struct("size", "root"))["root"].alias("main"))
    return stage(salted_join(named, main, "crowd", "set").filter("root <> main").select(
        "crowd", F.col("set").alias("a"), F.col("n").alias("n_a"), F.col("inside").alias("inside_a"), F.col("root").alias("root_a"), "main"), "strays")


def stray_pairs(crowd: DataFrame, named: DataFrame, strays: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b, est): what the classes outside a crowd's main component may still be similar to (cases i and ii above)."""
    strays = strays.drop("main")
    other = named.select("crowd", F.col("set").alias("b"), F.col("n").alias("n_b"), F.col("inside").alias("inside_b"), F.col("root").alias("root_b"))

    def step(n: Column) -> Column:
        return F.floor(F.log(n) / F.log(F.lit(1.02)))

    lowest = F.col("n_a") * (PERCENT / 100) * 0.999  # similar sets are alike in size
    highest = F.least(F.col("n_a") / (PERCENT / 100), (7 * F.col("inside_a") - 3 * F.col("n_a")) / 3) * 1.001
    short = strays.filter(highest >= lowest).select("crowd", "a", "n_a", "inside_a", "root_a", F.explode(F.sequence(step(lowest), step(highest))).alias("step"))
    enough = 7 * F.least("inside_a", "inside_b") >= 3 * (F.col("n_a") + F.col("n_b"))
    first = other.withColumn("step", step(F.col("n_b"))).join(short, ["crowd", "step"]).filter((F.col("root_a") != F.col("root_b")) & enough)
    rare = _rare_extras(crowd)
    second = rare.join(other.select("crowd", F.col("b").alias("set"), "root_b"), ["crowd", "set"]).withColumnRenamed("set", "b") \
        .join(rare.join(strays.select("crowd", F.col("a").alias("set"), "root_a"), ["crowd", "set"]).withColumnRenamed("set", "a"), ["crowd", "shingle"]) \
        .filter("root_a <> root_b")
    pairs = first.select("a", "b").union(second.select("a", "b")).distinct()
    return _alike(_with_sigs(pairs, sigs)).distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar enough; ``texts``: (set, text) of every class in a pair."""
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sets = shingle_sets(byte_texts(batch["text_a"]) + byte_texts(batch["text_b"]))
            keep = []
            for x, y in zip(sets[:n], sets[n:], strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("set").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("set").alias("b"), F.col("text").alias("text_b"))
    whole = pairs.select("a", "b").join(left, "a").join(right, "b")  # staged sides: Spark splits a hot key itself
    return stage(whole.select("a", "b", "text_a", "text_b").mapInArrow(confirm, "a binary, b binary"), "links")


def _different(pairs: DataFrame, roots: DataFrame, *more: str) -> DataFrame:
    """The pairs (a, b, root_a, root_b, ...) whose ends lie in different components."""
    for end in ("a", "b"):
        known = roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        pairs = salted_join(pairs, known, end, "b" if end == "a" else "a", how="left")
    pairs = pairs.withColumns({"root_a": F.coalesce("root_a", "a"), "root_b": F.coalesce("root_b", "b")})
    return pairs.filter("root_a <> root_b").select("a", "b", "root_a", "root_b", *more)


def hub_pairs(named: DataFrame, strays: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b): the strays of the crowds with the most alike of ``HUBS`` classes of the main component, nearest to P."""
    mains = strays.select("crowd", "main").distinct()
    of_main = salted_join(named, mains, "crowd", "set").filter("root = main")
    return _best_hubs(strays.select("crowd", "a"), _nearest_to_p(of_main, HUBS), sigs, FIRST_TRIES)


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components once ``links`` are added."""
    return connected_components(roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))


def confirm_in_rounds(rest: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
    """The components after all pairs (a, b, est) that could still join two of them were held against the full texts.

    A link between two components is enough: of their pairs the most alike few are confirmed first, then four times as
    many, and so on; pairs of components that are one by then are dropped.
    """
    tries = FIRST_TRIES
    while True:
        left = _different(rest, roots, "est")
        order = W.partitionBy("x", "y").orderBy(F.desc("est"), "a", "b")
        ends = left.withColumns({"x": F.least("root_a", "root_b"), "y": F.greatest("root_a", "root_b")})
        ranked = stage(ends.withColumn("nth", F.row_number().over(order)).select("a", "b", "est", "nth"), "rest")
        if ranked.isEmpty():
            return roots
        links = _confirmed(ranked.filter(F.col("nth") <= tries), texts)
        rest, tries = ranked.filter(F.col("nth") > tries).select("a", "b", "est"), tries * 4
        if not links.isEmpty():
            roots = _merged(roots, links)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for every row.

    Sets hold the distinct five-word shingles of the text with A-Z lower-cased (fewer words: the whole sequence as
    one); texts without words and null texts have an empty set and are linked with nothing.  Rows with a null id take
    no part: their component is null and they are kept.  Repeated rows get the same component, rows of one id with
    different texts the components of their texts; ``kept`` says whether the row's id is its component's smallest.
    Other columns are not read.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    sets = stage(_sets(docs), "sets")
    some = sets.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = some.groupBy("set").agg(F.min(F.struct("doc_id", "body", "sig")).alias("rep"))
    classes = stage(classes.select("set", "rep.doc_id", "rep.body", "rep.sig"), "classes")
    sigs, reps = classes.select("set", "sig"), classes.select("set", "doc_id", "body")
    candidates, crowds = find_candidates(sigs)
    wanted = candidates.select("a").union(candidates.select("b")).union(crowds.select("set")).toDF("set").distinct().join(reps, "set")
    named = docs.select("doc_id", F.xxhash64("text").alias("body"), "text")
    texts = stage(named.join(wanted, ["doc_id", "body"]).groupBy("set").agg(F.min("text").alias("text")), "texts")
    crowd = None if crowds.isEmpty() else profiles(crowds, texts)
    best = candidates.groupBy("b").agg(F.max(F.struct("est", "a"))["a"].alias("a")).select("a", "b")
    tried = stage(best if crowd is None else best.union(star_pairs(crowd, sigs)).distinct(), "tried")
    links = _confirmed(tried, texts)
    roots = connected_components(links)
    untried = candidates
    strays = None if crowd is None else strays_of(named := _with_roots(crowd, roots))
    if strays is not None and not strays.isEmpty():
        hubs = stage(hub_pairs(named, strays, sigs).join(tried, ["a", "b"], "left_anti"), "hub-pairs")
        found = _confirmed(hubs, texts)
        if not found.isEmpty():
            roots = _merged(roots, found)
            strays = strays_of(named := _with_roots(crowd, roots))
        tried = tried.union(hubs)
        if not strays.isEmpty():
            untried = untried.union(stray_pairs(crowd, named, strays, sigs)).distinct()
    roots = confirm_in_rounds(untried.join(tried, ["a", "b"], "left_anti"), roots, texts)
    labelled = reps.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    lowest = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = stage(salted_join(labelled, lowest, "root", "set").select("set", "component_id"), "components")
    joined = sets.select("doc_id", F.col("body").alias("text_hash"), "n_shingles", "set").join(of_class, "set", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id; a repeated row stays once.

    Rows without words and rows with a null id all stay.
    """
    found = near_duplicates(docs, key, text)
    marked = docs.withColumn(n := hidden("hash", docs.columns), F.xxhash64(text))
    g = hidden("gone", marked.columns)
    gone = found.filter(~F.col("kept")).select(F.struct("doc_id", "text_hash").alias(g)).distinct()
    left = marked.join(gone, (F.col(key) == F.col(f"{g}.doc_id")) & (F.col(n) == F.col(f"{g}.text_hash")), "left_anti")
    blank = F.col(key).isNull() | ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    nth = hidden("nth", left.columns)
    spread = F.when(blank, F.monotonically_increasing_id()).otherwise(F.lit(0))
    one = left.withColumn(s := hidden("spread", left.columns), spread)
    return one.withColumn(nth, F.row_number().over(W.partitionBy(key, n, s).orderBy(F.lit(0)))) \
        .filter(F.col(nth) == 1).select(*docs.columns)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT r, array_to_string(words[i : i + 4], ' ') AS shingle FROM texts, range(1, greatest(2, len(words) - 3)) t(i) WHERE len(words) > 0
), sizes AS (
  SELECT r, count(*) AS n FROM shingles GROUP BY r
), links AS (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS shared FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.r <> y.r GROUP BY a, b) p
  JOIN sizes m ON m.r = a JOIN sizes n ON n.r = b WHERE 100 * shared >= 75 * (m.n + n.n - shared)
), reached(a, b) AS (
  SELECT r, r FROM texts UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), components AS (
  SELECT a AS r, min(doc_id) AS component_id FROM reached JOIN texts ON texts.r = reached.b GROUP BY a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM texts JOIN components USING (r) LEFT JOIN sizes USING (r)
"""
