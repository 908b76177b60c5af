"""Similarity join on word n-grams by a token-group matrix.

Documents are sets of hashed shingles of five words; two are linked when
100 * |intersection| >= 80 * |union|. The steps:

1. Documents with equal sets are one (class); the smallest doc_id stands for it.
2. Similar documents meet in groups of at most ``GROUP``: the rows are sorted by
   MinHash values and cut where the value changes. Links within them join
   most copies at once (each document stands in a group for each of several
   MinHash values), so that a family of copies of any size is one component
   before its pairs are looked at.
3. A document's group is the largest it met in. The token-group matrix holds,
   for each group, the tokens of its members that can prove a link: of a set of
   n, any n - ceil(0.8 n) + 1 tokens that come first in one order of all tokens
   (those known as common come last). Its cells are dealt out by token, packed
   in blocks. Where documents of different components and groups meet in a
   token, the one of the rarer component becomes a query to the other's group.
   The tokens in which a query meets a group are added up; only if there are as
   many as a link leaves at least do they go on.
4. A group meets its queries in one task (in parts, if there are many). The
   overlap of a query with the union of the group's tokens bounds the overlap
   with each member; only a group whose bound reaches 0.8 of the query is
   opened and compared with its members, by exact counts.
5. Links, and equal sets, give connected components.

A link is left out only between documents that are known to be connected or
were compared in a group before, so components are exact. Which tokens count as common steers the order alone.

Null or blank texts have no shingles and link with nothing. Rows that share a
doc_id are one document: their components are one. Rows with a null doc_id have
no component and take no part. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import Batches, Shingles, batch_of, blended, in_batches, stored
from tillgrid.llm.components import components
from tillgrid.operators.joins import fits_broadcast, lookup_join

WIDTH, PERCENT = 5, 80
GROUP, QUERIES = 64, 256
SEEDS = (11, 23, 37, 53)  # of the MinHash values
# Common tokens: at least so often in all, so many at most (their size when broadcast), so many kept in a task.
COMMON_FROM, COMMON_TOKENS, COMMON_IN_TASK = 12, 1 << 16, 1 << 17
CELLS_IN_BLOCK = 500_000
BROADCAST_IDS, BROADCAST_CELLS = 1_000_000, 300_000


def least_overlap(n):
    """What a set of n shares at least with any set that it links to."""
    return (PERCENT * n + 99) // 100


def distinct_sorted(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])] if len(hashes) else hashes


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("binary").alias("text"))


def common_tokens(texts: DataFrame) -> np.ndarray:
    """Tokens found in many documents, rarest first: sums of what each task found most often, all texts read."""

    def most(tokens: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        tokens, at = np.unique(tokens, return_inverse=True)
        counts = np.bincount(at, counts, len(tokens)).astype(np.int64)
        if len(tokens) > n:
            keep = np.argpartition(-counts, n)[:n]
            tokens, counts = tokens[keep], counts[keep]
        return tokens, counts

    def run(batches: Batches) -> Batches:
        shingles = Shingles(WIDTH)
        tokens, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            found = np.sort(np.concatenate([distinct_sorted(shingles(t)) for t in batch.column(1).to_pylist()] or [tokens[:0]]))
            starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)
            often = np.diff(np.append(starts, len(found)))
            twice = often > 1
            tokens, counts = most(np.concatenate([tokens, found[starts[twice]]]), np.concatenate([counts, often[twice]]), COMMON_IN_TASK)
        yield pa.RecordBatch.from_arrays([pa.array(signed(tokens)), pa.array(counts)], names=["token", "n"])

    found = in_batches(texts, run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON_FROM)
    rows = found.orderBy(F.desc("n"), "token").limit(COMMON_TOKENS).collect()
    return np.array([r.token for r in reversed(rows)], np.int64).view(np.uint64)


SIGNATURE = pa.schema([
    ("doc", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("mins", pa.list_(pa.int64())), ("prefix", pa.binary()),
])


def signatures(texts: DataFrame, common: np.ndarray) -> DataFrame:
    """doc, n (set size), k1, k2 (hash of the set), mins (MinHash values), prefix (tokens that can prove a link).

    A task gives the last two once for a document's equal rows.
    """
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def run(batches: Batches) -> Batches:
        shingles, known, seen = Shingles(WIDTH), shared.value, set()
        places = np.argsort(known)
        ordered = known[places]
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = distinct_sorted(shingles(text))
                n = len(tokens)
                if not n:
                    rows.append((doc, 0, None, None, None, None))
                    continue
                digest = np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), np.int64)
                mark = doc, int(digest[0])
                if mark in seen:
                    rows.append((doc, n, int(digest[0]), int(digest[1]), None, None))
                    continue
                seen.add(mark)
                mins = [int(signed(blended(tokens ^ np.uint64(seed)).min(keepdims=True))[0]) for seed in SEEDS]
                if len(ordered):
                    at = np.minimum(np.searchsorted(ordered, tokens), len(ordered) - 1)
                    is_common = ordered[at] == tokens
                    if is_common.any():
                        last = tokens[is_common][np.argsort(places[at[is_common]])]
                        tokens = np.concatenate([tokens[~is_common], last])
                rows.append((doc, n, int(digest[0]), int(digest[1]), mins, tokens[: n - least_overlap(n) + 1].tobytes()))
            yield batch_of(SIGNATURE, list(map(list, zip(*rows))) if rows else [[]] * len(SIGNATURE))

    return in_batches(texts, run, "doc long, n long, k1 long, k2 long, mins array<long>, prefix binary")


def sets_of(texts: DataFrame, docs: DataFrame) -> DataFrame:
    """doc, tokens (sorted, packed) of the documents whose ids ``docs`` holds. Equal rows of a task count once."""

    def run(batches: Batches) -> Batches:
        shingles, seen = Shingles(WIDTH), set()
        for batch in batches:
            ids, sets = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packed = distinct_sorted(shingles(text)).tobytes()
                key = doc, xxhash.xxh3_64_intdigest(packed)
                if packed and key not in seen:
                    seen.add(key)
                    ids.append(doc)
                    sets.append(packed)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["doc", "tokens"])

    return in_batches(lookup_join(texts, docs, "doc", "left_semi", BROADCAST_IDS), run, "doc long, tokens binary")


def groups(rows: DataFrame) -> DataFrame:
    """seed, gid, doc of groups with more than one document; rows: doc, seed (a number), least (its MinHash value).

    Ranges of (seed, value, a hash of the document) are read as streams and cut
    where the value changes or a group is full; gid is a group's first document
    under that seed.
    """
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mixed = rows.withColumn("_order", F.xxhash64("doc", "seed"))
    dealt = mixed.repartitionByRange(count, "seed", "least", "_order").sortWithinPartitions("seed", "least", "_order", "doc").select("seed", "least", "doc")

    def run(batches: Batches) -> Batches:
        key, held = None, []

        def out(ready: list[list[int]]) -> pa.RecordBatch:
            gids = [xxhash.xxh3_64_intdigest(f"{s} {g[0]}".encode()) - (1 << 63) for s, g in ready for _ in g]
            seeds, docs = [s for s, g in ready for _ in g], [d for _, g in ready for d in g]
            return pa.RecordBatch.from_arrays([pa.array(seeds, pa.int32()), pa.array(gids, pa.int64()), pa.array(docs, pa.int64())], names=["seed", "gid", "doc"])

        for batch in batches:
            ready = []
            for seed, least, doc in zip(*(c.to_pylist() for c in batch.columns)):
                if (seed, least) != key or len(held) == GROUP:
                    if len(held) > 1:
                        ready.append((key[0], held))
                    key, held = (seed, least), []
                held.append(doc)
            yield out(ready)
        yield out([(key[0], held)] if len(held) > 1 else [])

    return in_batches(dealt, run, "seed int, gid long, doc long")


def overlaps(tokens: np.ndarray, inverted: tuple, n_members: int) -> tuple[int, np.ndarray | None]:
    """The bound of a query to a group (overlap with its union), and, if it qualifies, its overlap with each member."""
    union, starts, ends, owners = inverted
    at = np.searchsorted(union, tokens)
    at = at[union[np.minimum(at, len(union) - 1)] == tokens] if len(union) else at[:0]
    if len(at) < least_overlap(len(tokens)):
        return len(at), None
    lengths = ends[at] - starts[at]
    flat = np.arange(lengths.sum()) + np.repeat(starts[at] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return len(at), np.bincount(owners[flat], minlength=n_members)


def opened(cell: pa.Table) -> pa.Table:
    """Links of one cell: doc, comp, query (false: a member), tokens. Members are compared among themselves where no query is."""
    docs, comps, query = (cell.column(c).to_pylist() for c in ("doc", "comp", "query"))
    sets = [np.frombuffer(t, np.uint64) for t in cell.column("tokens").to_pylist()]
    order = sorted(range(len(docs)), key=lambda i: docs[i])
    members = [i for i in order if not query[i]]
    asking = [i for i in order if query[i]]
    roots: dict[int, int] = {}

    def root(x: int) -> int:
        while roots.setdefault(x, x) != x:
            roots[x] = x = roots[roots[x]]
        return x

    links = []
    if members:
        tokens = np.concatenate([sets[i] for i in members])
        owners = np.repeat(np.arange(len(members)), [len(sets[i]) for i in members])
        by = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[by], owners[by]
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        inverted = tokens[starts], starts, np.append(starts[1:], len(tokens)), owners
        sizes = np.array([len(sets[i]) for i in members])
        for turn, i in enumerate(asking or members):
            n = len(sets[i])
            _, shared = overlaps(sets[i], inverted, len(members))
            if shared is None:
                continue
            linked = 100 * shared >= PERCENT * (n + sizes - shared)
            if not asking:
                linked[turn:] = False
            for j in np.flatnonzero(linked):
                one, other = root(comps[i]), root(comps[members[j]])
                if one != other:
                    roots[max(one, other)] = min(one, other)
                    links.append((docs[i], docs[members[j]]))
    return pa.Table.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])


def links_in(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links found in cells (cell, part, doc, comp, query)."""
    side = F.broadcast(cells) if fits_broadcast(cells, BROADCAST_CELLS) else cells
    rows = sets.join(side, "doc").select("cell", "part", "doc", "comp", "query", "tokens")
    return rows.groupBy("cell", "part").applyInArrow(opened, "a long, b long")


def labelled(docs: DataFrame, comps: DataFrame) -> DataFrame:
    """Add comp (a document alone is its own) and size, the number of documents in it."""
    sizes = comps.groupBy("component").agg(F.count("*").alias("_size"))
    labels = comps.join(sizes, "component").select("doc", F.col("component").alias("_comp"), "_size")
    found = docs.join(labels, "doc", "left")
    return found.withColumns({"comp": F.coalesce("_comp", "doc"), "size": F.coalesce("_size", F.lit(1))}).drop("_comp", "_size")


COLUMNS = ("doc", "gid", "comp", "size", "n")


def matrix_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """block, cells (packed columns token and ``COLUMNS``): the matrix dealt out by token; rows: COLUMNS and prefix."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            prefix = [np.frombuffer(p, np.uint64) for p in batch.column(len(COLUMNS)).to_pylist()]
            each = [len(p) for p in prefix]
            tokens = np.concatenate(prefix)
            block = (blended(tokens) % np.uint64(blocks)).astype(np.int64)
            by = np.argsort(block, kind="stable")
            columns = [signed(tokens)[by]] + [np.repeat(batch.column(c).to_numpy(), each)[by] for c in range(len(COLUMNS))]
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(block[by]) != 0, [True]]))
            out = [np.concatenate([c[a:b] for c in columns]).astype(np.int64).tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(block[by][cuts[:-1]], pa.int64()), pa.array(out, pa.binary())], names=["block", "cells"])

    return in_batches(rows.select(*COLUMNS, "prefix"), run, "block long, cells binary")


# Runs of more rows are paired by group and size, so many pairs at a time.
LONG_RUN, PAIRS_AT_ONCE = 256, 100_000
MEETING = ("doc", "gid", "n", "shared", "least", "most")


def meetings(block: pa.Table) -> pa.Table:
    """Queries that meet a group of another component in tokens of the block.

    doc, gid, n (of the query), shared (tokens they meet in), least and most
    (sizes of the members met).
    """
    parts = [np.frombuffer(c, np.int64).reshape(1 + len(COLUMNS), -1) for c in block.column("cells").to_pylist()]
    token, *rows = np.concatenate(parts, axis=1)
    by = np.lexsort((rows[2], rows[3], token))  # in a token by size of the component, then component
    token, rows = token[by], np.stack([r[by] for r in rows])
    found = [added_up(pairs) for pairs in run_pairs(token, rows)]
    total = summed(np.concatenate(found, axis=1)) if found else np.zeros((6, 0), np.int64)
    return pa.Table.from_arrays([pa.array(c) for c in total], names=list(MEETING))


def run_pairs(token: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """Columns (run, doc, gid, n, m): in a token each document meets the documents of like size of components after its own.

    The rarer component asks, so a large one is met by the few others and never
    by itself. Short runs of equal length are taken together, long ones by
    ``long_run``.
    """
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(token) != 0, [True]])) if len(token) else np.zeros(1, np.int64)
    starts, lengths = cuts[:-1], np.diff(cuts)
    several = rows[2][starts] != rows[2][cuts[1:] - 1]
    starts, lengths = starts[several], lengths[several]
    for start, length in zip(starts[lengths > LONG_RUN].tolist(), lengths[lengths > LONG_RUN].tolist()):
        yield from long_run(start, rows[:, start : start + length])
    for length in np.unique(lengths[lengths <= LONG_RUN]):
        firsts = starts[lengths == length]
        together = max(1, 500_000 // int(length * length))
        for at in range(0, len(firsts), together):
            own = firsts[at : at + together]
            for shift in range(1, length):
                # every row with the one that stands ``shift`` after it in its run
                one = (own[:, None] + np.arange(length - shift)).ravel()
                pairs = paired(np.repeat(own, length - shift), one, one + shift, rows)
                if pairs.shape[1]:
                    yield pairs


def long_run(run: int, rows: np.ndarray) -> Iterator[np.ndarray]:
    """The columns of ``run_pairs`` for one long run.

    What a document meets counts by group and size, so equal ones of a component
    stand once. They are in order of the components, so a document meets all
    from the end of its own on: a component of any size costs nothing by itself.
    Pairs come in pieces, each reduced to the smallest and largest size met.
    """
    doc, gid, comp, _, n = rows
    place = np.cumsum(np.concatenate([[0], np.diff(comp) != 0]))
    met = np.unique(np.stack([place, gid, n]), axis=1)
    after = np.searchsorted(met[0], place, side="right")
    counts = met.shape[1] - after
    asking = np.flatnonzero(counts)
    pieces = np.cumsum(counts[asking]) // PAIRS_AT_ONCE
    for own in np.split(asking, np.flatnonzero(np.diff(pieces)) + 1):
        many = counts[own]
        one = np.repeat(own, many)
        other = np.repeat(after[own] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        m = met[2][other]
        like = (gid[one] != met[1][other]) & (100 * np.minimum(n[one], m) >= PERCENT * np.maximum(n[one], m))
        one, group, m = one[like], met[1][other][like], m[like]
        if not len(one):
            continue
        by = np.lexsort((m, group, one))
        one, group, m = one[by], group[by], m[by]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(one) != 0) | (np.diff(group) != 0)]))
        last = np.concatenate([first[1:] - 1, [len(one) - 1]])
        ends = np.unique(np.concatenate([first, last]))
        yield np.stack([np.full(len(ends), run), doc[one[ends]], group[ends], n[one[ends]], m[ends]])


def paired(run: np.ndarray, one: np.ndarray, other: np.ndarray, rows: np.ndarray) -> np.ndarray:
    doc, gid, comp, _, n = rows
    like = (comp[one] != comp[other]) & (gid[one] != gid[other]) & (100 * np.minimum(n[one], n[other]) >= PERCENT * np.maximum(n[one], n[other]))
    return np.stack([run[like], doc[one[like]], gid[other[like]], n[one[like]], n[other[like]]])


def added_up(pairs: np.ndarray) -> np.ndarray:
    return np.stack([*pairs[:4], pairs[4], pairs[4]])


def summed(found: np.ndarray) -> np.ndarray:
    """From (run, doc, gid, n, least, most) the columns of ``MEETING``: a run counts once for a query and a group."""
    run, doc, gid, n, least, most = found[:, np.lexsort((found[0], found[3], found[2], found[1]))]
    if not len(run):
        return np.zeros((6, 0), np.int64)
    new_pair = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(gid) != 0) | (np.diff(n) != 0)])
    new_run = new_pair | np.concatenate([[True], np.diff(run) != 0])
    starts = np.flatnonzero(new_pair)
    return np.stack([
        doc[starts], gid[starts], n[starts], np.add.reduceat(new_run.astype(np.int64), starts),
        np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts),
    ])


def least_meetings(n, m):
    """Tokens that the prefixes of linked sets of n and m share at least.

    Linked sets share at least 80 / 180 of n + m. Of the two prefixes take the
    one whose last token comes first: what its set shares beyond that prefix is
    no more than the rest of the set.
    """
    shared = F.ceil((n + m) * PERCENT / (100 + PERCENT))
    rest = F.greatest(F.ceil(n * PERCENT / 100), F.ceil(m * PERCENT / 100)) - 1
    return F.greatest(F.lit(1), shared - rest)


def qualified(met: DataFrame) -> DataFrame:
    """doc, gid of the queries whose meetings in all blocks leave a link possible.

    The bound is the lowest of all sizes from the smallest to the largest member
    met. Up to m = n it never falls, as only what is shared grows. From there it
    falls by 16 / 45 a step but for two ceilings, which raise it by 1 at most,
    so the lowest value beyond n is at one of the last three sizes.
    """
    sums = met.groupBy("doc", "gid", "n").agg(F.sum("shared").alias("shared"), F.min("least").alias("least"), F.max("most").alias("most"))
    sizes = [F.col("least"), *(F.greatest("least", F.col("most") - back) for back in range(3))]
    return sums.where(F.col("shared") >= F.least(*(least_meetings(F.col("n"), m) for m in sizes))).select("doc", "gid").distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    texts = texts_of(docs)
    signs = stored(signatures(texts, common_tokens(texts)), "jaccard-signs")
    named = signs.where("n > 0 and doc is not null")
    classes = stored(named.groupBy("k1", "k2").agg(F.min("doc").alias("first")), "jaccard-classes")
    same = named.select("k1", "k2", "doc").join(classes, ["k1", "k2"]).select(F.col("doc").alias("a"), F.col("first").alias("b")).where("a <> b")
    firsts = classes.select(F.col("first").alias("doc"), "k1", "k2")
    bearing = signs.where("prefix is not null")
    alike = stored(groups(bearing.select("doc", "k1", "k2", "mins").join(firsts, ["doc", "k1", "k2"]).select("doc", F.posexplode("mins").alias("seed", "least"))), "jaccard-groups")
    sets = stored(sets_of(texts, alike.select("doc").distinct()), "jaccard-alike")
    cells = alike.select(F.col("gid").alias("cell"), F.lit(0).alias("part"), "doc", F.col("doc").alias("comp"), F.lit(False).alias("query"))
    links = stored(links_in(cells, sets), "jaccard-links")
    comps = stored(components(links), "jaccard-families")

    # of the groups a document met in, the largest is its group in the matrix; one that met none is a group alone
    sizes = alike.groupBy("gid").agg(F.count("*").alias("of"))
    own = alike.join(sizes, "gid").groupBy("doc").agg(F.max_by("gid", F.struct("of", "gid")).alias("gid"))
    labels = labelled(firsts, comps).join(own, "doc", "left").withColumn("gid", F.coalesce("gid", "doc"))
    labels = stored(labels, "jaccard-labels")
    side = F.broadcast(labels) if fits_broadcast(labels, BROADCAST_CELLS) else labels
    grouped = bearing.select("doc", "k1", "k2", "n", "prefix").join(side, ["doc", "k1", "k2"])
    cells_in_all = bearing.agg(F.coalesce(F.sum(F.octet_length("prefix")), F.lit(0))).first()[0] // 8
    blocks = matrix_blocks(grouped, max(1, -(-cells_in_all // CELLS_IN_BLOCK)))
    met_in = blocks.groupBy("block").applyInArrow(meetings, ", ".join(f"{c} long" for c in MEETING))
    asked = stored(qualified(met_in), "jaccard-queries")

    members = labels.select("gid", "doc").distinct()
    parts = asked.groupBy("gid").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
    placed = asked.join(parts, "gid").select("gid", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int").alias("part"), "doc", F.lit(True).alias("query"))
    repeated = members.join(parts, "gid").select("gid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "doc", F.lit(False).alias("query"))
    met = stored(labelled(placed.union(repeated), comps).select(F.col("gid").alias("cell"), "part", "doc", "comp", "query"), "jaccard-cells")
    more = stored(sets_of(texts, met.select("doc").distinct()), "jaccard-met")
    links = links.union(links_in(met, more)).union(same)
    found = stored(components(links), "jaccard-components")
    return (
        signs.select("doc", "n").join(found, "doc", "left")
        .select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))
    )


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of its component; rows without id or shingles stay."""
    gone = stored(jaccard_components(docs).where("doc_id <> component_id").select("doc_id").distinct(), "jaccard-gone")
    return lookup_join(docs, gone, "doc_id", "left_anti", BROADCAST_IDS)
