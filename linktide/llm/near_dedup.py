"""MinHash near-duplicates by an inverted join of signature coordinates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.llm.common import mixed, shingle_sets, table, text_blocks
from linktide.llm.components import components
from linktide.llm.membership import IdFilter
from linktide.scratch import Scratch

COORDINATES = 64
# At a similarity of 0.8, 64 coordinates agree 51.2 times, with a deviation of 3.2: fewer
# than 33 have a chance of about 1e-8.
LEAST_MATCHES = 33
GROUP_ROWS = 1000

_FACTORS = np.random.default_rng(5).integers(1, 1 << 62, COORDINATES, np.uint64) * np.uint64(
    2
) + np.uint64(1)
_SHIFTS = np.random.default_rng(6).integers(0, (1 << 64) - 1, COORDINATES, np.uint64)


def _set_id(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """``(rows, COORDINATES)``: the least value per coordinate, as 64-bit integers."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    least = np.empty((len(sets), COORDINATES), np.uint64)
    for j in range(COORDINATES):
        least[:, j] = np.minimum.reduceat(joined * _FACTORS[j] + _SHIFTS[j], starts)
    return mixed(least + np.arange(COORDINATES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, n_shingles, set_id, signature)``: 64-bit coordinate-value pairs, null for
    a text without words; ``set_id`` names the set by 128 bits of its digest."""
    schema = "doc_id long, n_shingles long, set_id binary, signature array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text"):
            sets = shingle_sets(data, offsets, words)
            full = [s for s in sets if len(s)]
            marks = _signatures(full).view(np.int64) if full else np.zeros((0, COORDINATES), np.int64)
            ids = [_set_id(s) if len(s) else None for s in sets]
            sizes = np.array([len(s) for s in sets])
            ends = np.cumsum(np.where(sizes > 0, COORDINATES, 0))
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(marks.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), lists],
                ["doc_id", "n_shingles", "set_id", "signature"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def prefix_postings(classes: DataFrame, least_matches: int = LEAST_MATCHES) -> DataFrame:
    """``(pair, set_id, weight)``: the coordinate-value pairs of each class's prefix.

    Pairs are ordered from rare to frequent. Two classes that agree on ``least_matches``
    coordinates share a pair among the first ``COORDINATES - least_matches + 1`` of
    either, so the longest lists are skipped. Pairs of one class only take their places
    in the prefix but need no posting. ``weight`` is high for the centre of a group.
    """
    postings = classes.select("set_id", F.explode("signature").alias("pair"))
    prefix = F.lit(COORDINATES - least_matches + 1)
    return _rare_first(postings.withColumns({"total": F.lit(COORDINATES), "prefix": prefix}))


def _rare_first(postings: DataFrame) -> DataFrame:
    """``(pair, set_id, weight)`` of the ``prefix`` rarest of a set's ``total`` postings."""
    lists = postings.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    by_class = postings.join(lists, "pair").groupBy("set_id", "total", "prefix").agg(
        F.sort_array(F.collect_list(F.struct("n", "pair"))).alias("pairs"),
        F.sum(F.round(F.log2("n") * 1024).cast("long")).alias("weight"),
    )
    left = (F.col("prefix") - (F.col("total") - F.size("pairs"))).cast("int")
    return by_class.where(left > 0).select(
        F.explode(F.slice(F.col("pairs.pair"), F.lit(1), left)).alias("pair"), "set_id", "weight"
    )


def shingle_postings(sets: DataFrame, percent: int) -> DataFrame:
    """``(pair, set_id, weight)``: each set's rarest shingles among ``sets(set_id, shingles)``.

    Sets whose similarity is ``percent``/100 or more share that part of either's shingles, so
    they share one of the ``n - ceil(n percent / 100) + 1`` rarest. What many sets have in
    common, as a licence or a page's frame, is last in this order and posts nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for set_id, shingles in zip(batch.column("set_id").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
                found = np.frombuffer(shingles, np.int64)
                n = len(found)
                prefix = n - -(-n * percent // 100) + 1
                columns = [pa.array([set_id] * n, pa.binary()), pa.array(found), *[pa.array([v] * n, pa.int32()) for v in (n, prefix)]]
                yield pa.RecordBatch.from_arrays(columns, ["set_id", "pair", "total", "prefix"])

    schema = "set_id binary, pair long, total int, prefix int"
    return _rare_first(sets.select("set_id", "shingles").mapInArrow(run, schema))


def leader_groups(postings: DataFrame) -> DataFrame:
    """``(leader, set_id)``: each list's members go to the list's central member.

    Lists that share a leader become one group, so that a class is moved and compared
    once per leader and not once per list; any two members of a list share a group.
    """
    leaders = postings.groupBy("pair").agg(
        F.max(F.struct("weight", "set_id")).alias("top"), F.count(F.lit(1)).alias("n")
    )
    leaders = leaders.where("n > 1").select("pair", F.col("top.set_id").alias("leader"))
    return postings.join(leaders, "pair").select("leader", "set_id").distinct()


class _Block:
    """Sets and signatures of one group's members, compared without forming pairs."""

    def __init__(self, frame: pd.DataFrame, percent: int, least_matches: int):
        self.ids = frame["set_id"].to_list()
        self.sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        self.marks = np.stack(frame["signature"].to_list())
        self.sizes = np.array([len(s) for s in self.sets])
        self.percent, self.least = percent, least_matches

    def linked(self, i: int, among: np.ndarray) -> np.ndarray:
        """Those of ``among`` that are linked with member ``i``."""
        low, high = self.sizes[among], self.sizes[i]
        fits = 100 * np.minimum(low, high) >= self.percent * np.maximum(low, high)
        among = among[fits]
        among = among[(self.marks[among] == self.marks[i]).sum(axis=1) >= self.least]
        if not len(among):
            return among
        own = self.sets[i]
        joined = np.concatenate([self.sets[j] for j in among])
        place = np.minimum(np.searchsorted(own, joined), len(own) - 1)
        starts = np.cumsum([0, *self.sizes[among[:-1]]])
        shared = np.add.reduceat((own[place] == joined).astype(np.int64), starts)
        union = self.sizes[among] + len(own) - shared
        return among[100 * shared >= self.percent * union]


def _links(a: list[bytes], b: list[bytes]) -> pd.DataFrame:
    return pd.DataFrame({"a": pd.Series(a, dtype=object), "b": pd.Series(b, dtype=object)})


def _group_links(block: _Block, first: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A spanning forest of the links inside one group, starting at member ``first``."""
    left, links = np.delete(np.arange(len(block.ids)), first), []
    queue = [first]
    while len(left) or queue:
        if not queue:
            queue, left = [int(left[0])], left[1:]
        i = queue.pop()
        found = block.linked(i, left)
        links += [(i, int(j)) for j in found]
        queue += found.tolist()
        left = np.setdiff1d(left, found, assume_unique=True)
    return links, left


def exact_links(
    groups: DataFrame, sets: DataFrame, scratch: Scratch, percent: int, least_matches: int,
    group_rows: int = GROUP_ROWS, by_shingle: bool = False,
) -> DataFrame:
    """``(a, b)``: links between classes that connect what all links would connect.

    ``groups(leader, set_id)``, ``sets(set_id, signature, shingles)``. Inside a group a
    pair counts if its signatures agree ``least_matches`` times and then by the full
    sets; members that are connected already are not compared. A group above
    ``group_rows`` is dealt out: its members meet the leader in blocks. Where it does not
    link them all, the members of such groups are grouped anew by their rarest shingles
    (``by_shingle``), so that texts which only have common passages part. If a leader of
    those does not link all of a large group either, the rest meets every block of it.
    """
    sized = groups.groupBy("leader").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members, seen = scratch.save(
        groups.join(sized, "leader").join(sets, "set_id"), "members", {"most": F.max("n")}
    )
    link = "a binary, b binary"
    small = members.where(F.col("n") <= group_rows)

    def within(frame: pd.DataFrame) -> pd.DataFrame:
        block = _Block(frame, percent, least_matches)
        links, _ = _group_links(block, block.ids.index(frame["leader"].iloc[0]))
        return _links([block.ids[i] for i, _ in links], [block.ids[j] for _, j in links])

    links = small.groupBy("leader").applyInPandas(within, link)
    if (seen["most"] or 0) <= group_rows:
        return links

    blocks = F.ceil(F.col("n") / group_rows)
    large = members.where(F.col("n") > group_rows).withColumn(
        "block", F.pmod(F.xxhash64("set_id"), blocks)
    )
    hub = large.where("set_id = leader").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    )
    starred = large.where("set_id <> leader").union(hub)

    def with_leader(frame: pd.DataFrame) -> pd.DataFrame:
        block = _Block(frame, percent, least_matches)
        first = block.ids.index(frame["leader"].iloc[0])
        others = np.delete(np.arange(len(block.ids)), first)
        found = set(block.linked(first, others).tolist())
        left = [i for i in others if i not in found]
        ends = [block.ids[i] for i in [*found, *left]]
        marks = [False] * len(found) + [True] * len(left)
        return _links([block.ids[first]] * len(ends), ends).assign(left=marks)

    starred = starred.groupBy("leader", "block").applyInPandas(with_leader, f"{link}, left boolean")
    starred, _ = scratch.save(starred, "starred")
    links = links.union(starred.where("not left").select("a", "b"))
    left = starred.where("left").select(F.col("a").alias("leader"), F.col("b").alias("set_id"))
    if not by_shingle:
        unlinked, _ = scratch.save(left.select("leader").distinct(), "unlinked")
        again = large.join(unlinked, "leader", "left_semi").select("set_id").distinct()
        again, _ = scratch.save(sets.join(again, "set_id", "left_semi"), "again")
        postings, _ = scratch.save(shingle_postings(again, percent), "shingle_postings")
        anew, _ = scratch.save(leader_groups(postings), "shingle_groups")
        return links.union(exact_links(anew, again, scratch, percent, least_matches, group_rows, by_shingle=True))
    counts = left.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / group_rows).alias("parts"))
    place = F.pmod(F.xxhash64("set_id"), F.col("parts"))
    probes = (
        large.join(left, ["leader", "set_id"]).join(counts, "leader").withColumn("part", place)
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("probe", F.lit(True))
    )
    builds = (
        large.join(counts, "leader")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumn("probe", F.lit(False))
    )

    def across(frame: pd.DataFrame) -> pd.DataFrame:
        block = _Block(frame, percent, least_matches)
        probe = frame["probe"].to_numpy()
        build, a, b = np.flatnonzero(~probe), [], []
        for i in np.flatnonzero(probe):
            found = block.linked(int(i), build)
            a += [block.ids[i]] * len(found)
            b += [block.ids[j] for j in found]
        return _spanning(a, b)

    columns = [*members.columns, "block", "part", "probe"]
    dealt = probes.select(columns).union(builds.select(columns))
    dealt = dealt.groupBy("leader", "part", "block").applyInPandas(across, link)
    return links.union(dealt)


def _spanning(a: list[bytes], b: list[bytes]) -> pd.DataFrame:
    """Of one task's links, as many as keep everything connected."""
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    kept = []
    for x, y in zip(a, b, strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[p] = q
            kept.append((x, y))
    return _links([x for x, _ in kept], [y for _, y in kept])


def near_duplicates(
    docs: DataFrame, scratch: Scratch, *, words: int = 5, percent: int = 80,
    least_matches: int = LEAST_MATCHES, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Two documents are linked if the sets of their ``words``-word shingles (white-space
    words, A-Z lower-cased; a shorter text is one shingle) have a Jaccard similarity of
    ``percent``/100 or more; ``component_id`` is the least doc_id that can be reached.
    Equal sets are one class and never form pairs. Candidates are classes whose MinHash
    signatures agree on ``least_matches`` coordinates, links are confirmed on full sets.

    A null or empty text, or one without words, has no shingles and is linked with
    nothing: its component is its own doc_id. Rows that repeat a doc_id each get a row;
    a null doc_id gets the component of its text and is never kept. An empty table
    gives an empty result; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    signed, _ = scratch.save(signatures(docs, words), "signatures")
    worded = signed.where("set_id is not null")
    classes = worded.groupBy("set_id").agg(F.first("signature").alias("signature"))
    postings, _ = scratch.save(prefix_postings(classes, least_matches), "postings")
    groups, _ = scratch.save(leader_groups(postings), "groups")
    # One row of each class brings its text; which one does not matter.
    wanted = groups.select("set_id").distinct()
    holders = worded.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    holders = holders.join(wanted, "set_id").select("doc_id")
    holders, unnamed = scratch.save(holders, "holders", {"n": F.count_if(F.col("doc_id").isNull())})
    # A filter by doc_id lets few other texts pass, and no text has to move to be found.
    texts, _ = IdFilter(holders, "doc_id", scratch).split(docs, "doc_id")
    if unnamed["n"]:  # classes of rows without a doc_id only
        texts = texts.union(docs.where("doc_id is null"))
    sets = _class_sets(texts, words).join(wanted, "set_id", "left_semi")
    sets = sets.groupBy("set_id").agg(F.first("shingles").alias("shingles"))
    sets = sets.join(classes, "set_id")
    links = exact_links(groups, sets, scratch, percent, least_matches, group_rows)
    roots = components(links, scratch).select(F.col("node").alias("set_id"), "root")
    # The least doc_id of each class, then of each component, both combined before they move.
    least = worded.groupBy("set_id").agg(F.min("doc_id").alias("least"))
    least = least.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    least, _ = scratch.save(least, "classes")
    tops = least.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = least.join(tops, "root").select("set_id", "component_id")
    result = signed.select("doc_id", "n_shingles", "set_id").join(of_class, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def _class_sets(texts: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in text_blocks(batches, "text"):
            sets = [s for s in shingle_sets(data, offsets, words) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_id(s) for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())],
                ["set_id", "shingles"],
            )

    return texts.mapInArrow(run, "set_id binary, shingles binary")


def drop_near_duplicates(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, all columns kept.

    The one with the least doc_id stays; rows that repeat it in doc_id and text are one
    document. Texts without words stay. So do rows without a doc_id, as they can't be
    named.
    """
    with Scratch(docs.sparkSession) as steps:  # they go before the result is read
        rows = near_duplicates(docs, steps, **options).where("doc_id is not null")
        counted = rows.groupBy("doc_id").agg(F.count_if("kept").alias("n"), F.count(F.lit(1)).alias("rows"))
        counted, _ = scratch.save(counted, "kept")
    # Rows that are surely the one kept row of their doc_id stay where they are; only the
    # others, and the few that the filter takes for them, move to be looked up.
    doubted = counted.where("n <> 1 or rows <> 1")
    asked, sure = IdFilter(doubted, "doc_id", scratch).split(docs, "doc_id")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = asked.join(counted.where("n = 1 and rows = 1").select("doc_id"), "doc_id", "left_semi")
    again = asked.join(counted.where("n > 0 and rows > 1").select("doc_id"), "doc_id", "left_semi")
    again = again.dropDuplicates(["doc_id", "text"])
    return sure.union(once.select(columns)).union(again.select(columns))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark), words=4)
