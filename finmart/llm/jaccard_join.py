"""Similar documents by the Jaccard similarity of word shingles, with a token-group matrix.

Similar documents are put into one group by the least hash of their shingles. The matrix says which shingles the
prefixes of a group's members hold, and how large a set each can still link with; groups that share too few such
shingles, or none that reaches the other, cannot hold a link. Of the pairs of groups that are left, a group meets the
other as queries: a query's overlap with the group's token union bounds its overlap with every member, and only a group
whose bound suffices is opened and its members are compared exactly.

The prefix of a set of n shingles is its first n - ceil(t n) + 1 in a global order. Two sets of similarity t or more
share a shingle of their prefixes whatever the order; this one puts frequent shingles last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.llm.base import WordHashes, blank_words, mixed, ngram_hashes, small_side, sorted_groups, texts, Union
from finmart.llm.components import components
from finmart.session import written

# A group holds about this many documents and shingles at most.
GROUP_ROWS = 256
GROUP_TOKENS = 262_144
# Sizes in a group differ by this factor at most, so that the bounds of a group stay close to those of its members.
SIZE_BAND = 1.4
# Queries that one task compares with a group, about.
QUERY_ROWS = 2048
# A shingle is frequent when more prefixes than this hold it; at most FREQUENT_MOST shingles are.
FREQUENT = 64
FREQUENT_MOST = 1_000_000
# The number of the first row without an id.
UNNAMED = 1 << 62


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; a shorter text is one shingle, no word none."""
    return np.unique(ngram_hashes(words, min(n, len(words)))) if len(words) else np.empty(0, np.uint64)


def needed_overlap(size, percent: int):
    """Shingles that a set of ``size`` must share with any set of similarity ``percent`` / 100."""
    return (size * percent + 99) // 100


def prefix(tokens: np.ndarray, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first tokens of a sorted set, frequent ones last by how often they occur."""
    take = len(tokens) - needed_overlap(len(tokens), percent) + 1
    if not len(tokens):
        return tokens
    hot, counts = frequent
    if not len(hot):
        return tokens[:take]
    at = np.searchsorted(hot, tokens)
    at[at == len(hot)] = 0
    weight = np.where(hot[at] == tokens, counts[at], 0)
    return tokens[np.argsort(weight, kind="stable")[:take]]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _prefix_counts(n: int, percent: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        frequent = shared.value
        for batch in batches:
            parts = [prefix(shingle_set(hashes.of(blank_words(raw)), n), percent, frequent) for raw in texts(batch)]
            tokens, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *parts]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(tokens)), pa.array(counts)], names=["token", "n"])
    return run


def _digests(n: int, percent: int, shared):
    """Set size, 128-bit name of the set, least second hash, and prefix of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        frequent = shared.value
        for batch in batches:
            sizes, names, least, prefixes = [], [], [], []
            for raw in texts(batch):
                tokens = shingle_set(hashes.of(blank_words(raw)), n)
                sizes.append(len(tokens))
                names.append(xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None)
                least.append(int(_signed(mixed(tokens)).min()) if len(tokens) else 0)
                prefixes.append(_signed(prefix(tokens, percent, frequent)))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            values = pa.array(np.concatenate([np.empty(0, np.int64), *prefixes]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(least, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), values)],
                names=["id", "n_shingles", "name", "least", "prefix"])
    return run


def _own_sets(task: pa.Table, n: int, hashes: WordHashes) -> tuple[pa.Table, list[np.ndarray]]:
    """The rows of a task whose text has the set that its row names, each document once, and these sets."""
    rows, sets, last = [], [], None
    for i, (node, name, raw) in enumerate(zip(task.column("node").to_pylist(), task.column("name").to_pylist(), texts(task))):
        if node == last:
            continue  # a document that repeats its id
        tokens = shingle_set(hashes.of(blank_words(raw)), n)
        if len(tokens) and xxhash.xxh3_128_digest(tokens.tobytes()) == name:
            rows.append(i)
            sets.append(tokens)
            last = node
    return task.select(["node", "role", "copies"]).take(pa.array(rows, pa.int64())), sets


class TokenGroup:
    """A group's token union and, for each token, the members that hold it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        member = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.member = member[order]
        self.union, first = np.unique(tokens[order], return_index=True)
        self.first = np.append(first, len(tokens))

    def linked(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Members whose similarity with the query is ``percent`` / 100 or more."""
        at = np.searchsorted(self.union, query)
        at[at == len(self.union)] = 0
        at = at[self.union[at] == query]
        if len(at) < needed_overlap(len(query), percent):
            return np.empty(0, np.int64)  # the bound: the group stays closed
        start, size = self.first[at], self.first[at + 1] - self.first[at]
        places = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        common = np.bincount(self.member[places], minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= percent * (len(query) + self.sizes - common))


def _open_groups(n: int, percent: int):
    """Links between the members of a group, and with the documents of its query groups, as (node, root, links)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for task in sorted_groups(batches, "task"):
            task, sets = _own_sets(task, n, hashes)
            node = task.column("node").to_numpy()
            role = task.column("role").to_numpy()  # 0: member, 1: query, 2: member that is also compared inside
            copies = task.column("copies").to_numpy()
            members = np.flatnonzero(role != 1)
            if not len(members):
                continue
            group = TokenGroup([sets[i] for i in members])
            union, links = Union(len(node)), np.zeros(len(node), np.int64)
            for q in range(len(node)):
                if role[q] == 0:
                    continue
                found = members[group.linked(sets[q], percent)]
                found = found[found != q] if role[q] == 1 else found[found > q]
                links[q] += copies[found].sum()
                links[found] += copies[q]
                for m in found.tolist():
                    union.join(q, m)
            out = np.flatnonzero(links)
            if len(out):
                roots = node[[union.find(int(i)) for i in out]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[out]), pa.array(roots), pa.array(links[out])], names=["node", "root", "links"])
    return run


def _frequent(slim: DataFrame, n: int, percent: int, rounds: int):
    """Frequent prefix shingles with their counts; moving them back brings new ones up, so it is done again."""
    spark = slim.sparkSession
    known = (np.empty(0, np.uint64), np.empty(0, np.int64))
    for _ in range(rounds):
        counts = written(slim.mapInArrow(_prefix_counts(n, percent, spark.sparkContext.broadcast(known)),
                                         "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
                         .where(f"n > {FREQUENT}"), "frequent")
        total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
        # fewer than FREQUENT_MOST tokens can hold more than this share of the total
        rows = counts.where(F.col("n") > max(FREQUENT, total // FREQUENT_MOST)).toArrow()
        tokens = rows.column("token").to_numpy().view(np.uint64)
        fresh = ~np.isin(tokens, known[0])
        merged = np.concatenate([known[0], tokens[fresh]])
        weights = np.concatenate([known[1], rows.column("n").to_numpy()[fresh]])
        order = np.argsort(merged)
        known = merged[order], weights[order]
        if fresh.sum() < 0.05 * len(merged) or len(merged) > FREQUENT_MOST:
            break
    return spark.sparkContext.broadcast(known)


def _named(number) -> Column:
    value = F.col(number) if isinstance(number, str) else number
    return F.when(value < UNNAMED, value)


def similar_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 85,
                      rounds: int = 2) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id``, ``n_links``: one row per document.

    Documents with equal shingle sets are one class from the start; ``n_links`` counts linked documents, copies
    included, and ``component_id`` is the smallest id that links reach. NULL texts and texts without words have no
    shingle and link with nothing. A row without an id is a document like others, only that no component has its name: a
    component of such rows alone is NULL. Ids lie below 2**62. Documents that repeat an id stay rows; if their texts differ they are judged apart. An empty table gives none.
    """
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # rows without an id get numbers behind all ids, which a later job finds again since they are stored
    unnamed = slim.where("id IS NULL").select((F.lit(UNNAMED) + F.monotonically_increasing_id()).alias("id"), "text")
    slim = slim.where("id IS NOT NULL").unionByName(written(unnamed, "unnamed"))
    frequent = _frequent(slim.select("text"), words, percent, rounds)
    digests = written(slim.mapInArrow(
        _digests(words, percent, frequent),
        "id bigint, n_shingles bigint, name binary, least bigint, prefix array<bigint>"), "digests")
    classes = digests.where("name IS NOT NULL").groupBy("name").agg(
        F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n"),
        F.first("least").alias("least"), F.first("prefix").alias("prefix"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    # documents of one least hash and size band are a group; those that are too many for one are dealt to several
    kind = ["least", "band"]
    banded = classes.withColumn("band", F.floor(F.log("n") / F.log(F.lit(SIZE_BAND))))
    sums = banded.groupBy(*kind).agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens"))
    chunks = F.ceil(F.greatest(F.col("rows") / GROUP_ROWS, F.col("tokens") / GROUP_TOKENS))
    full = written(sums.select(*kind, chunks.alias("chunks")).where("chunks > 1"), "full")
    grouped = banded.join(small_side(full), kind, "left").withColumn("group", F.xxhash64(
        *kind, F.pmod(F.xxhash64("node"), F.coalesce("chunks", F.lit(1)))))
    groups = grouped.groupBy("group").agg(
        F.count(F.lit(1)).alias("rows"), F.min("n").alias("low"), F.max("n").alias("high"))
    groups = written(groups, "groups")

    # the matrix: which groups hold a token in a prefix; a token that only one document holds joins nothing
    common = classes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("held"))
    common = written(common.where("held > 1").select("token"), "common")
    # sets of x and y shingles share p (x + y) / (100 + p), all of it from their first common token on: behind i others of
    # x shingles, that token reaches sets of (x - i) (100 + p) / p - x shingles at most
    held = grouped.select("group", "n", F.posexplode("prefix").alias("at", "token")).join(small_side(common), "token")
    matrix = held.groupBy("token", "group").agg(
        F.min("n").alias("low"), F.max(F.expr(f"(n - at) * {100 + percent} div {percent} - n")).alias("reach"))
    matrix = written(matrix, "matrix")
    other = F.col("group").alias("other")
    partners = matrix.select("token", other, F.col("low").alias("other_low"), F.col("reach").alias("other_reach"))
    pairs = matrix.join(partners, "token").where("group < other").groupBy("group", "other").agg(
        F.count(F.lit(1)).alias("shared"),
        F.max((F.col("low") <= F.col("other_reach")) & (F.col("other_low") <= F.col("reach"))).alias("reached"))
    others = groups.select(other, *(F.col(c).alias(f"other_{c}") for c in ("rows", "low", "high")))
    high, low = F.greatest("high", "other_high"), F.least("low", "other_low")
    # sets of x >= y shingles share p (x + y) / (100 + p); p x / 100 of them at most lie behind the prefix that ends first
    least = percent * (high + low) / (100 + percent) - percent * high / 100
    pairs = pairs.join(groups, "group").join(others, "other").where(
        (100 * F.col("high") >= percent * F.col("other_low")) & (100 * F.col("other_high") >= percent * F.col("low"))
        & (F.col("shared") >= least) & F.col("reached"))
    # the smaller group asks the larger one
    turned = F.col("rows") < F.col("other_rows")
    asked = pairs.select(F.when(turned, F.col("other")).otherwise(F.col("group")).alias("group"),
                         F.when(turned, F.col("group")).otherwise(F.col("other")).alias("other"),
                         F.least("rows", "other_rows").alias("queries"))
    alone = groups.where("rows > 1").select("group", F.col("group").alias("other"), F.lit(0).cast("long").alias("queries"))
    asked = written(asked.unionByName(alone), "asked")
    many = written(asked.groupBy("group").agg(F.sum("queries").alias("queries")), "many")
    share = F.pmod(F.xxhash64("other"), F.greatest(F.ceil(F.col("queries") / QUERY_ROWS), F.lit(1)))
    tasks = written(asked.drop("queries").join(small_side(many), "group").select(
        "group", "other", F.xxhash64("group", share).alias("task")), "tasks")

    # a member is wanted once for a task, a query for each task its group is asked in
    member = tasks.groupBy("task", "group").agg(
        F.max(F.when(F.col("group") == F.col("other"), 2).otherwise(0)).alias("role"))
    asked = tasks.where("group <> other").select("task", F.col("other").alias("group"), F.lit(1).alias("role"))
    calls = written(member.unionByName(asked), "calls")
    wanted = grouped.where("least_id IS NOT NULL").select(F.col("least_id").alias("id"), "name", "node", "group", "copies")
    wanted = written(wanted.join(small_side(calls), "group").drop("group"), "wanted")
    # texts travel, which are smaller than their sets, and a task makes the sets of its documents
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met_rows = slim.join(small_side(wanted), "id").select("task", "node", "role", "copies", "name", "text")
    links = written(met_rows.repartition(parts, "task").sortWithinPartitions("task", "node").mapInArrow(
        _open_groups(words, percent), "node bigint, root bigint, links bigint"), "links")

    degree = links.groupBy("node").agg(F.sum("links").alias("others"))
    reached = components(links.select("node", "root")).join(classes.select("node", "least_id"), "node")
    least = reached.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = reached.select("node", "root").join(least, "root").select("node", "component_id")
    told = classes.join(degree, "node", "left").join(named, "node", "left").select(
        "name", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "least_id").alias("component_id"))
    return digests.select("id", "n_shingles", "name").join(written(told, "told"), "name", "left").select(
        _named("id").alias("id"), "n_shingles", _named(F.coalesce("component_id", "id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
