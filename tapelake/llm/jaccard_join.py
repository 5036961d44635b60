"""Exact Jaccard self-join of documents on distinct word shingles, by T-occurrence search over inverted lists.

Two sets of sizes m and n reach a Jaccard similarity of p percent only if they share T = ceil(p (m + n) / (100 + p)) elements:
a document has to occur on T of the inverted lists of the other one's shingles. The job:

1. Documents with the same word sequence form one class. Its node is its smallest doc_id; where that is the smallest one of several
   classes, a doc_id standing on several texts, all but one of them have a number of their own.
2. Most shingles occur in one class only. For linked documents, the first ``n - t + n / 8`` hashes of each set (t is the least
   overlap any link needs) hold at least about n / 10 common ones. Whoever shares fewer with all other classes is linked with
   nothing. The hashes are dealt by value to tasks that count them; one that several documents of a batch share is sent once.
3. The shared shingles of the classes that are left, ordered from rare to frequent, give inverted lists. Linked documents meet on
   a list of one of their first n - t + 1 shingles, so the components of these lists (families) hold all links.
4. Each family is searched by DivideSkip: merge the short lists of a document, probe the long ones by binary search for what
   could still reach T. A large family is cut into size classes and blocks, and each pair of blocks that can hold links is a
   task, so that no task grows with a family.
5. Components of the links.

Defined results: texts that are null, empty or without words have an empty set and are linked with nothing; rows without doc_id
get their ``n_shingles`` and a null component; repeated rows and copies are one class, and each row is returned; different texts
under one doc_id are documents of their own, whose links all count. Only the two columns named are read, so others may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import Forest, components, few, freed, shuffle_partitions, small_batches, spare
from tapelake.llm.shingles import WIDTH, as_bytes, distinct_shingles, split_words
from tapelake.plans.staging import stage

PERCENT = 75
# Hashes counted by a task of step 2, and list entries held by a task of step 4.
COUNTED = 2_000_000
BLOCK = 1_000_000


def least_overlap(n, percent: int):
    """Common elements that a set of ``n`` needs for a link with any other set."""
    return (percent * n + 99) // 100


def class_key(words: list[bytes]) -> bytes | None:
    """128 bits that stand for a word sequence."""
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def owner_number(key: bytes) -> int:
    """The half of a class key that goes with its hashes in step 2; never 0."""
    return int.from_bytes(key[:8], "little", signed=True) | 1


def _class_rows(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            keys, counts = [], []
            for text in as_bytes(batch.column("text")):
                words = split_words(text)
                counts.append(len(distinct_shingles(words, width)))
                keys.append(class_key(words))
            owners = [None if key is None else owner_number(key) for key in keys]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "tie": batch.column("tie"),
                    "class": pa.array(keys, pa.binary()),
                    "owner": pa.array(owners, pa.int64()),
                    "n_shingles": pa.array(counts, pa.int64()),
                }
            )

    return rows


def classes(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row per document: doc_id, tie (of its text), class (null without words), owner (the class's number in step 2), n_shingles."""
    text = F.col("text").cast("string")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    return rows.mapInArrow(freed(_class_rows(width)), "doc_id long, tie long, class binary, owner long, n_shingles long")


def _prefix_blobs(width: int, percent: int, parts: int):
    """Per batch and part of the hash range: the prefix hashes, each with its class, or with 0 where several classes share it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, tokens, owners = set(), [], []
            for piece in small_batches(iter([batch]), "text"):
                for text in as_bytes(piece.column("text")):
                    words = split_words(text)
                    key = class_key(words)
                    if words and key not in seen:
                        seen.add(key)
                        found = distinct_shingles(words, width)
                        n = len(found)
                        tokens.append(found[: n - least_overlap(n, percent) + max(1, n // 8)])
                        owners.append(np.full(len(tokens[-1]), owner_number(key), np.int64))
            if not tokens:
                continue
            token, owner = np.concatenate(tokens), np.concatenate(owners)
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            first = np.append(True, token[1:] != token[:-1])
            alone = first & np.append(first[1:], True)
            yield from _credits(owner[~alone], parts)
            owner = np.where(alone, owner, 0)[first]
            token = token[first]
            part = (token >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            low = token.astype(np.uint32)
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            ends = np.append(cuts[1:], len(part))
            yield pa.record_batch(
                {
                    "part": pa.array(part[cuts].astype(np.int64)),
                    "tokens": pa.array([low[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
                    "owners": pa.array([owner[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
                }
            )

    return rows


def _credits(owner: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """A row of a negative part that says how many shared hashes each class is known to have; parts differ by batch."""
    if len(owner):
        key, count = np.unique(owner, return_counts=True)
        part = -1 - int(key[0]) % parts
        blobs = [count.astype(np.uint32).tobytes()], [key.tobytes()]
        yield pa.record_batch({"part": pa.array([part], pa.int64()), "tokens": pa.array(blobs[0], pa.binary()), "owners": pa.array(blobs[1], pa.binary())})


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part -> (owner, shared): for each class, how many of its hashes another class or batch has too."""
    part, tokens, owners = None, [], []

    def counted() -> Iterator[pa.RecordBatch]:
        if not tokens:
            return
        token, owner = np.concatenate(tokens), np.concatenate(owners)
        if part < 0:
            key, inverse = np.unique(owner, return_inverse=True)
            count = np.bincount(inverse, weights=token).astype(np.int64)
        else:
            order = np.lexsort((owner, token))
            token, owner = token[order], owner[order]
            same = token[1:] == token[:-1]
            kept = np.append(True, ~(same & (owner[1:] == owner[:-1])) | (owner[1:] == 0))  # copies in other batches count once
            token, owner = token[kept], owner[kept]
            same = token[1:] == token[:-1]
            shared = np.append(False, same) | np.append(same, False)
            key, count = np.unique(owner[shared & (owner != 0)], return_counts=True)
        if len(key):
            yield pa.record_batch({"owner": pa.array(key), "shared": pa.array(count.astype(np.int64))})

    for batch in batches:
        for p, t, o in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if p != part:
                yield from counted()
                part, tokens, owners = p, [], []
            tokens.append(np.frombuffer(t, np.uint32))
            owners.append(np.frombuffer(o, np.int64))
    yield from counted()


def _token_rows(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            keys, tokens = [], []
            for text in as_bytes(batch.column("text")):
                words = split_words(text)
                keys.append(class_key(words))
                tokens.append(distinct_shingles(words, width).astype(np.int64))
            yield pa.record_batch({"least": batch.column("doc_id"), "class": pa.array(keys, pa.binary()), "tokens": pa.array(tokens, pa.list_(pa.int64()))})

    return rows


def likely(documents: DataFrame, heads: DataFrame, width: int, percent: int) -> DataFrame:
    """Step 2: (node, least, n, class) of the classes that share enough of their first hashes with others."""
    spark = documents.sparkSession
    total = heads.agg(F.sum("n")).first()[0] or 0
    parts = max(1, math.ceil(total * 0.4 / COUNTED))
    rows = documents.select(F.col("text").cast("string").alias("text"))
    blobs = rows.mapInArrow(freed(_prefix_blobs(width, percent, max(parts, shuffle_partitions(spark)))), "part long, tokens binary, owners binary")
    dealt = blobs.repartition(max(parts, shuffle_partitions(spark)), "part").sortWithinPartitions("part")
    shared = dealt.mapInArrow(freed(_shared_counts), "owner long, shared long").groupBy("owner").agg(F.sum("shared").alias("shared"))
    # A partner has at least least_overlap(n) elements and an eighth of them, one at least, beyond its own shortest prefix.
    asked = F.greatest(F.lit(1), F.floor(F.floor((F.lit(percent) * F.col("n") + 99) / 100) / 8))
    return heads.join(shared, "owner").where(F.col("shared") >= asked).select("node", "least", "n", "class")


def inverted(documents: DataFrame, chosen: DataFrame, width: int, percent: int) -> DataFrame:
    """Step 3: (node, n, tokens, family); the shared shingles of each class from rare to frequent."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = rows.join(chosen.select(F.col("least").alias("doc_id")), "doc_id", "left_semi")
    sets = stage(texts.mapInArrow(freed(_token_rows(width)), "least long, class binary, tokens array<long>"), "sets")
    sets = sets.join(chosen, ["least", "class"]).dropDuplicates(["node"])
    entries = sets.select("node", "n", F.explode("tokens").alias("token"))
    lists = entries.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    kept = entries.join(lists, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("lists"))
    needed = F.floor((F.lit(percent) * F.col("n") + 99) / 100)
    kept = kept.where(F.size("lists") >= needed).withColumn("first", (F.size("lists") - needed + 1).cast("int"))
    kept = stage(kept.select("node", "n", "first", F.col("lists.token").alias("tokens")), "lists")
    heads = kept.select("node", F.explode(F.slice("tokens", F.lit(1), F.col("first"))).alias("token"))
    stars = heads.join(heads.groupBy("token").agg(F.min("node").alias("least")), "token").where("node <> least")
    family = components(stars.select("node", "least").distinct(), "node", "least")
    return stage(kept.join(family, "node").select("node", "n", "tokens", F.col("component").alias("family")), "families")


def divide_skip(sizes: np.ndarray, tokens: list[np.ndarray], percent: int, ahead: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(query, members linked with it) for the sets of one task.

    ``tokens[i]`` are the list names of set i, ``sizes[i]`` its whole size. Only members after the query are returned, or those
    marked in ``ahead`` for queries that aren't marked.
    """
    counts = np.array([len(t) for t in tokens])
    names, entry = np.unique(np.concatenate(tokens), return_inverse=True)
    member = np.repeat(np.arange(len(tokens)), counts)
    by_list = np.argsort(entry, kind="stable")
    members, starts = member[by_list], np.append(0, np.cumsum(np.bincount(entry, minlength=len(names))))
    own = np.append(0, np.cumsum(counts))
    longest = np.log2(max(2, int(np.diff(starts).max())))
    for query in range(len(tokens)):
        if ahead is not None and ahead[query]:
            continue
        lists = entry[own[query] : own[query + 1]]
        lengths = starts[lists + 1] - starts[lists]
        least = int(least_overlap(int(sizes[query]), percent))
        # DivideSkip: the more lists are left to binary search, the weaker the bound for the merge of the others.
        n_long = min(least - 1, int(least / (0.01 * longest + 1) / 2), int((lengths > 8).sum()))
        order = lists[np.argsort(lengths, kind="stable")]
        short, long = order[: len(order) - n_long], order[len(order) - n_long :]
        merged = np.sort(np.concatenate([members[starts[k] : starts[k + 1]] for k in short]))
        cuts = np.flatnonzero(np.append(True, merged[1:] != merged[:-1]))
        found, hits = merged[cuts], np.diff(np.append(cuts, len(merged)))
        wanted = (percent * (sizes[query] + sizes[found]) + 99 + percent) // (100 + percent)
        kept = (hits + n_long >= wanted) & (ahead[found] if ahead is not None else found > query)
        found, hits, wanted = found[kept], hits[kept], wanted[kept]
        for done, k in enumerate(long):
            if not len(found):
                break
            held = members[starts[k] : starts[k + 1]]
            at = np.searchsorted(held, found)
            hits = hits + (held[np.minimum(at, len(held) - 1)] == found)
            kept = hits + (n_long - done - 1) >= wanted
            found, hits, wanted = found[kept], hits[kept], wanted[kept]
        if len(found):
            yield query, found


def _search(percent: int):
    """One group: a whole family, or a pair of blocks (side 0 asks, side 1 answers; one block with itself has no side 1)."""

    def search(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n", "node"], kind="stable")
        nodes, sizes = group["node"].to_numpy(), group["n"].to_numpy()
        ahead = (group["side"] == 1).to_numpy()
        forest, links = Forest(), []
        for query, found in divide_skip(sizes, [np.asarray(t) for t in group["tokens"]], percent, ahead if ahead.any() else None):
            links += [(int(nodes[query]), int(nodes[k])) for k in found if forest.join(int(nodes[query]), int(nodes[k]))]
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return search


def links(sets: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Step 4: links (a, b) that connect the same nodes as all links do."""
    load = stage(sets.groupBy("family").agg(F.sum(F.size("tokens")).alias("load")), "loads")
    total = load.agg(F.sum("load")).first()[0] or 0
    sets = sets.join(load, "family")
    tasks = max(shuffle_partitions(sets.sparkSession), math.ceil(total / block))  # small families share a task
    whole = sets.where(F.col("load") <= block).withColumn("task", F.pmod(F.xxhash64("family"), F.lit(tasks)))
    whole = whole.select("task", F.lit(0).alias("side"), "node", "n", "tokens")
    found = whole.groupBy("task").applyInPandas(_search(percent), "a long, b long")

    # Sizes of linked sets differ by a factor of 100 / percent at most, so they are in the same or neighbouring classes.
    classed = sets.where(F.col("load") > block).withColumn("size_class", F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent) + 1e-9)))
    blocks = classed.groupBy("family", "size_class").agg(F.ceil(F.sum(F.size("tokens")) / F.lit(block)).alias("blocks"))
    above = blocks.select("family", (F.col("size_class") - 1).alias("size_class"), F.col("blocks").alias("above"))
    below = blocks.select("family", (F.col("size_class") + 1).alias("size_class"), F.col("blocks").alias("below"))
    placed = (
        classed.join(blocks, ["family", "size_class"])
        .join(above, ["family", "size_class"], "left")
        .join(below, ["family", "size_class"], "left")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    )
    mine = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)

    def name(*numbers):
        return F.concat_ws("/", F.col("family").cast("string"), *(n.cast("string") for n in numbers))

    c, own = F.col("size_class"), F.col("block")
    same = F.transform(mine, lambda k: F.struct(name(c, F.least(k, own), c, F.greatest(k, own)).alias("task"), F.when(own > k, 1).otherwise(0).alias("side")))
    up = F.transform(F.sequence(F.lit(0).cast("long"), F.col("above") - 1), lambda k: F.struct(name(c, own, c + 1, k).alias("task"), F.lit(0).alias("side")))
    down = F.transform(F.sequence(F.lit(0).cast("long"), F.col("below") - 1), lambda k: F.struct(name(c - 1, k, c, own).alias("task"), F.lit(1).alias("side")))
    none = F.array().cast("array<struct<task:string,side:int>>")
    routes = F.concat(same, F.coalesce(up, none), F.coalesce(down, none))
    paired = placed.select(F.explode(routes).alias("route"), "node", "n", "tokens").select("route.task", "route.side", "node", "n", "tokens")
    return found.unionByName(paired.groupBy("task").applyInPandas(_search(percent), "a long, b long"))


def labelled(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Staged rows (doc_id, tie, class, owner, n_shingles) of all documents, and (class, least, group, label) of the classes: the
    smallest doc_id of the class, its component, and the smallest doc_id of that."""
    rows = stage(classes(documents, width), "classes")
    owned = rows.where("doc_id IS NOT NULL AND class IS NOT NULL")
    heads = stage(owned.groupBy("class", "owner").agg(F.min("doc_id").alias("least"), F.min("n_shingles").alias("n")), "heads")
    heads = with_nodes(heads)
    chosen = stage(likely(documents, heads, width, percent), "likely")
    found = stage(links(inverted(documents, chosen, width, percent), percent, block), "links")
    reached = components(found, "a", "b").join(heads.select("node", "least", "class"), "node")
    label = reached.groupBy("component").agg(F.min("least").alias("label"))
    reached = reached.join(label, "component").select("class", F.col("component").alias("group"), "label")
    joined = heads.join(reached, "class", "left")
    return rows, joined.select("class", "least", F.coalesce("group", "node").alias("group"), F.coalesce("label", "least").alias("label"))


def with_nodes(heads: DataFrame) -> DataFrame:
    """Classes with a ``node`` that no other class has: ``least``, or a number beyond 2**62 where another class has it."""
    shared = stage(heads.groupBy("least").agg(F.count("*").alias("classes"), F.min("class").alias("first")).where("classes > 1"), "shared-ids")
    if not shared.limit(1).count():
        return heads.withColumn("node", F.col("least"))
    own = F.xxhash64("class").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    joined = heads.join(few(shared.select("least", "first")), "least", "left")
    return joined.withColumn("node", F.when(F.col("first").isNull() | (F.col("first") == F.col("class")), F.col("least")).otherwise(own)).drop("first")


def jaccard_components(documents: DataFrame, **options) -> DataFrame:
    """A row per document (doc_id, text): doc_id, n_shingles, component_id, the smallest doc_id reachable by links."""
    rows, labels = labelled(documents, **options)
    label = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return rows.join(labels, "class", "left").select("doc_id", "n_shingles", label.alias("component_id"))


def keep_one(documents: DataFrame, **options) -> DataFrame:
    """One document of each component, that of the smallest doc_id, all columns as they are.

    Documents without a doc_id or words stay; rows that repeat a doc_id and a text count as copies.
    """
    rows, labels = labelled(documents, **options)
    first = labels.groupBy("group").agg(F.min(F.struct("least", "class")).alias("first"))
    owned = rows.where("doc_id IS NOT NULL AND class IS NOT NULL")
    leaders = first.select(F.col("first.class").alias("class"), F.col("first.least").alias("doc_id"))
    kept = owned.join(leaders, ["class", "doc_id"]).groupBy("class", "doc_id").agg(F.min("tie").alias("tie"))
    doc, tie = spare(documents.columns, "doc", "tie")
    named = [F.col("doc_id").alias(doc), F.col("tie").alias(tie)]
    gone = stage(owned.join(kept, ["class", "doc_id", "tie"], "left_anti").select(*named).distinct(), "gone")
    same = (documents["doc_id"].cast("long") == F.col(doc)) & (F.xxhash64(documents["text"].cast("string")) == F.col(tie))
    left = documents.join(few(gone), same, "left_anti")
    # What stays may still be repeated row by row.
    repeated = owned.join(kept, ["class", "doc_id", "tie"], "left_semi").groupBy("doc_id", "tie").count().where("count > 1").select(*named)
    repeated = stage(repeated, "repeated")
    if not repeated.limit(1).count():
        return left
    same = (left["doc_id"].cast("long") == F.col(doc)) & (F.xxhash64(left["text"].cast("string")) == F.col(tie))
    copies = left.join(few(repeated), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(few(repeated), same, "left_anti").unionByName(copies)
