"""N-gram Jaccard join by chosen paths.

A document is its set of word shingles; documents of equal sets are one class. Sets are split
recursively on shared tokens: at a node each set follows the tokens whose hash, keyed by the node,
is below branch / (threshold * size). Two sets of at least the threshold follow a common token with
probability 1 - exp(-branch) or more, so independent runs are repeated until the target recall,
what splits below lose included. Small nodes are compared by brute force. A large node is divided by
size, then judged by its tokens, counted in blocks of its sets: where they share most of them on average it is
compared in blocks dealt over tasks, otherwise it is split on the tokens that less than about half of it holds.
A set's tokens that most of its node holds, such as a common line, say nothing about a pair, so they are
left out, and the others followed the more often; sets of little else meet in a child of their own. Nodes
of the same members travel as one, but are split by the key of each, so that their losses stay independent.
Nothing is capped: every pair in a final node is compared exactly, and each similar pair is
counted in the least final node that both sets share.

A line of many texts would make nodes of all of them at the root. Such tokens are looked for in a sample of texts; which
ones it finds costs no pair. A set that mostly holds others does not follow them, but its others the more often, as if
it had no more; one that they make up half of follows all its tokens as they are, and those between follow both.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provtally.llm.common import bucketed, components, stored, with_group
from provtally.llm.words import Words, buffers, chunks, lists, mix, mixed, signed, unsigned, whole_groups

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Sets in a node that is compared at once, and side length of a block of a larger one.
NODE = 768
#: Shingles in such a block.
NODE_TOKENS = 1_500_000
#: Expected shared children of a similar pair: at the root, where runs repeat it, and below.
BRANCH_ROOT, BRANCH_BELOW = 1.0, 4.0
#: A token that this share of a node's sets holds is common there.
COMMON = 0.4
#: The share of a block of such a node, some NODE sets, that it holds by all odds.
OFTEN = 0.3
#: Two sets of the threshold differ in at most (1 - t) / t of either; this much more has to be uncommon for a split.
MARGIN = 0.1
DEPTH = 6
#: Texts that are looked at for tokens of many texts, the groups they are counted in, and the share of texts that is many.
SAMPLE, SAMPLE_GROUPS, WIDESPREAD = 4096, 8, 0.02
#: Share of a set's tokens, not widespread, that similar sets share at least if they leave the widespread ones alone.
OTHERS = 0.3


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and distinct shingle hashes, sorted by row; a row of 1 to n - 1 words has one shingle of all."""
    start, value = words.windows(n)
    row = words.row[start]
    for length in range(1, n):
        brief, hashes = words.windows(length)
        brief_row = words.row[brief]
        alone = words.count[brief_row] == length
        row, value = np.concatenate((row, brief_row[alone])), np.concatenate((value, hashes[alone] ^ mixed(length)))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def _below(branch: float, threshold: float | np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash bound for following a token of a set of so many."""
    return (np.minimum(1.0, branch / (threshold * np.maximum(size, 1))) * float(2**64 - 2**12)).astype(np.uint64)


def _runs(recall: float) -> int:
    """Runs after which a pair at the threshold is missed with chance 1 - recall at most, however often its nodes are split."""
    lost = 0.0
    for _ in range(DEPTH):
        lost = math.exp(-BRANCH_BELOW * (1 - lost))
    return math.ceil(math.log(1 - recall) / (-BRANCH_ROOT * (1 - lost)))


def _is_in(value: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the known ones, which are sorted."""
    return known[np.minimum(np.searchsorted(known, value), len(known) - 1)] == value if len(known) else np.zeros(len(value), dtype=bool)


def _edges(threshold: float) -> tuple[float, float]:
    """Shares of a set's tokens that are not widespread: those from which it follows them alone, and below which it follows all.

    Of a set A whose similar sets lack 1 - t of it at most, they hold the share of others less 1 - t. If A is below the
    first edge e, a similar set of I + y tokens, I of them in A's I + x, x + y <= (1 - t) / t * I, has at most e (I + x) + y
    others, so is below the second edge: of two similar sets both follow the others, or both follow all.
    """
    low = 1 - threshold + OTHERS
    return low, max(low / threshold, threshold * low + 1 - threshold)


def _bounds(row: np.ndarray, value: np.ndarray, size: np.ndarray, widespread: np.ndarray, threshold: float) -> np.ndarray:
    """Hash bound for following each token at the root."""
    known = _is_in(value, widespread)
    others = np.bincount(row[~known], minlength=len(size)) / np.maximum(size, 1)
    low, high = _edges(threshold)
    everything = np.where(others < high + 1e-9, _below(BRANCH_ROOT, threshold, size), 0).astype(np.uint64)
    shared = np.maximum(others - (1 - threshold), OTHERS)
    alone = np.where(others >= low - 1e-9, _below(BRANCH_ROOT, shared, size), 0).astype(np.uint64)
    return np.where(known, everything[row], np.maximum(everything, alone)[row])


def _sampled(n: int, share: float) -> Callable:
    """(token, texts, common): of a group of sampled texts, tokens that half the share of them holds, and how much of their holders is such tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("part",)):
            part = table.column("part").to_numpy()
            edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            for low, high in zip(edges, edges[1:], strict=False):
                raw, at = buffers(table.column("text").slice(low, high - low))
                found = [shingles(Words(raw, at, first, last), n) + (first,) for first, last in chunks(at)]
                row = np.concatenate([r + first for r, _, first in found])
                token, place, texts = np.unique(np.concatenate([v for _, v, _ in found]), return_inverse=True, return_counts=True)
                often = texts >= max(2, share / 2 * (high - low))
                size = np.bincount(row, minlength=high - low)
                common = np.bincount(row, weights=often[place], minlength=high - low) / np.maximum(size, 1)
                summed = np.bincount(place, weights=common[row], minlength=len(token))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(token[often])), pa.array(texts[often].astype(np.int64)), pa.array(summed[often])],
                    names=["token", "texts", "common"],
                )

    return count


def _widespread(source: DataFrame, n: int, threshold: float) -> np.ndarray:
    """Sorted tokens that more than NODE texts hold by a sample of some SAMPLE texts, unless they make up most of those.

    Any tokens would do, so what the sample misses only costs time. At most the mean set over WIDESPREAD come to the driver.
    """
    total = source.count()
    if total <= NODE:
        return np.zeros(0, dtype=np.uint64)
    rate = min(1.0, SAMPLE / total)
    share = max(WIDESPREAD, NODE / total)
    place = F.pmod(F.xxhash64(F.lit("sample"), "text_hash"), F.lit(1 << 30))
    texts = source.where(F.col("text").isNotNull() & (place < int(rate * (1 << 30)))).groupBy("text_hash").agg(F.any_value("text").alias("text"))
    dealt = texts.select("text", F.pmod("text_hash", F.lit(SAMPLE_GROUPS)).cast("int").alias("part"))
    dealt = dealt.repartition(SAMPLE_GROUPS, "part").sortWithinPartitions("part")
    counts = dealt.mapInArrow(_sampled(n, share), "token long, texts long, common double")
    held = counts.groupBy("token").agg(F.sum("texts").alias("texts"), F.sum("common").alias("common"))
    often = held.where((F.col("texts") >= share * rate * total) & (F.col("common") <= (1 - _edges(threshold)[0]) * F.col("texts")))
    return np.sort(unsigned(np.array([r["token"] for r in often.select("token").collect()], dtype=np.int64)))


def _scanner(n: int, threshold: float, runs: int, seed: int, widespread: np.ndarray) -> Callable:
    keys_of_run = [mixed(seed * 1000 + r + 1) for r in range(runs)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = buffers(batch.column(1))
            for first, last in chunks(at):
                words = Words(raw, at, first, last)
                row, value = shingles(words, n)
                size = np.bincount(row, minlength=last - first)
                bound = _bounds(row, value, size, widespread, threshold)
                rows, keys = [], []
                for key in keys_of_run:
                    chosen = mix(value ^ key)
                    hit = chosen <= bound
                    rows.append(row[hit])
                    keys.append(mix(value[hit] + key))
                owner, node = np.concatenate(rows), np.concatenate(keys)
                order = np.argsort(owner, kind="stable")
                one, two = np.zeros(last - first, np.uint64), np.zeros(last - first, np.uint64)
                np.add.at(one, row, mix(value ^ mixed(11)))
                np.add.at(two, row, mix(value ^ mixed(12)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(2).slice(first, last - first),
                        pa.array(size.astype(np.int64)),
                        pa.array([f"{a:016x}{b:016x}" for a, b in zip(one.tolist(), two.tolist(), strict=True)]),
                        lists(pa.array(signed(node[order])), np.bincount(owner, minlength=last - first)),
                    ],
                    names=["doc_id", "text_hash", "size", "digest", "nodes"],
                )

    return scan


def _setter(n: int) -> Callable:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = buffers(batch.column("text"))
            for first, last in chunks(at):
                row, value = shingles(Words(raw, at, first, last), n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rep").slice(first, last - first),
                        batch.column("copies").slice(first, last - first),
                        pa.array(np.bincount(row, minlength=last - first).astype(np.int64)),
                        lists(pa.array(signed(value)), np.bincount(row, minlength=last - first)),
                    ],
                    names=["rep", "copies", "size", "tokens"],
                )

    return sets


def _spare(threshold: float) -> float:
    """The most of a set that a similar set can lack."""
    return (1 - threshold) / threshold


def _least(threshold: float) -> float:
    """Share of a set's tokens, uncommon in their node, that similar sets share at least unless both are of common tokens."""
    return MARGIN * threshold


def _looked_at(tokens: np.ndarray, key: np.uint64, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of a set that a node counts: all that a split may follow; and their hashes."""
    hashed = mix(tokens ^ key)
    seen = hashed <= _below(BRANCH_BELOW, _least(threshold), np.array([len(tokens)]))
    return tokens[seen], hashed[seen]


def _looker(threshold: float) -> Callable:
    """(node, block, held): per set the children that the tokens looked at lead to."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, sets = unsigned(batch.column("node").to_numpy()), batch.column("tokens")
            at, flat = sets.offsets.to_numpy(), unsigned(sets.values.to_numpy())
            keys = mix(node ^ mixed(7))
            held = [mix(_looked_at(flat[at[i] : at[i + 1]], keys[i], threshold)[0] + keys[i]) for i in range(len(node))]
            if held:
                children = lists(pa.array(signed(np.concatenate(held))), np.array([len(x) for x in held]))
                yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("block"), children], names=["node", "block", "held"])

    return look


def _counter() -> Callable:
    """(node, pairs, possible, common, n): what the sets of a block of a node share, one row per block.

    pairs of possible: how often a token looked at is held by another set of the block; common: the children of tokens
    that a share of OFTEN holds there, at most so many as a set looks at over that share, each held by n sets.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("node", "block")):
            node, block, sets = table.column("node").to_numpy(), table.column("block").to_numpy(), table.column("held").combine_chunks()
            row, flat = _flat(sets)
            edge = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]) | (block[1:] != block[:-1]))))
            pairs, possible, common, counts = [], [], [], []
            for low, high in zip(edge, np.append(edge[1:], len(node)), strict=True):
                child, n = np.unique(flat[slice(*np.searchsorted(row, [low, high]))], return_counts=True)
                pairs.append(float((n * (n - 1.0)).sum()))
                possible.append(float(n.sum()) * (high - low - 1))
                often = n >= OFTEN * (high - low)
                common.append(child[often])
                counts.append(n[often].astype(np.int64))
            held = np.array([len(x) for x in common])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(node[edge]), pa.array(pairs), pa.array(possible),
                    lists(pa.array(signed(np.concatenate(common))), held), lists(pa.array(np.concatenate(counts)), held),
                ],
                names=["node", "pairs", "possible", "common", "n"],
            )

    return count


def _splitter(threshold: float) -> Callable:
    """Children that the sets of a node follow: uncommon tokens, and one child for sets of little else than common ones."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, rep = unsigned(batch.column("node").to_numpy()), batch.column("rep").to_numpy()
            sets, common = batch.column("tokens"), batch.column("common")
            at, common_at = sets.offsets.to_numpy(), common.offsets.to_numpy()
            flat, known = unsigned(sets.values.to_numpy()), unsigned(common.values.to_numpy())
            keys = mix(node ^ mixed(7))
            reps, children = [], []
            for i in range(len(node)):
                size = int(at[i + 1] - at[i])
                tokens, hashed = _looked_at(flat[at[i] : at[i + 1]], keys[i], threshold)
                child = mix(tokens + keys[i])
                own = ~np.isin(child, known[common_at[i] : common_at[i + 1]])
                uncommon = float(own.mean()) if len(own) else 0.0
                shared = max(uncommon - _spare(threshold), _least(threshold))
                followed = child[own & (hashed <= _below(BRANCH_BELOW, shared, np.array([size])))]
                if uncommon <= _spare(threshold) + MARGIN:
                    followed = np.append(followed, keys[i] ^ mixed(8))
                reps.append(np.full(len(followed), rep[i]))
                children.append(followed)
            if reps:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(reps)), pa.array(signed(np.concatenate(children)))], names=["rep", "node"]
                )

    return split


def _overlaps(rows: np.ndarray, tokens: np.ndarray, n: int) -> np.ndarray:
    """Numbers of shared tokens of all pairs of n sets, by matrix products over tokens of two sets at least."""
    order = np.argsort(tokens, kind="stable")
    tokens, rows = tokens[order], rows[order]
    new = np.concatenate(([True], tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, dtype=bool)
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(tokens)))
    column = np.repeat(np.where(count > 1, np.cumsum(count > 1) - 1, -1), count)
    rows, column = rows[column >= 0], column[column >= 0]
    out = np.zeros((n, n), dtype=np.float32)
    width = 2048
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, [low, low + width]))
        slab = np.zeros((n, width), dtype=np.float32)
        slab[rows[part], column[part] - low] = 1
        out += slab @ slab.T
    return out


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of each list element."""
    at = column.offsets.to_numpy()
    return np.repeat(np.arange(len(column)), np.diff(at)), unsigned(column.values.to_numpy()[at[0] : at[-1]])


def _comparer(threshold: float) -> Callable:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("node", "one", "two")):
            column = {c: table.column(c).combine_chunks() for c in ("node", "one", "two", "block", "rep", "copies", "tokens", "nodes")}
            node, rep, copies = unsigned(column["node"].to_numpy()), column["rep"].to_numpy(), column["copies"].to_numpy()
            one, two, block = (column[c].to_numpy() for c in ("one", "two", "block"))
            edge = np.flatnonzero(
                np.concatenate(([True], (node[1:] != node[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
            )
            token_at, leaf_at = column["tokens"].offsets.to_numpy(), column["nodes"].offsets.to_numpy()
            tokens, leaves = unsigned(column["tokens"].values.to_numpy()), unsigned(column["nodes"].values.to_numpy())
            size = np.diff(token_at)
            out_rep, out_label, out_links = [], [], []
            for low, high in zip(edge, np.append(edge[1:], len(node)), strict=True):
                n = high - low
                if n < 2:
                    continue
                own = np.repeat(np.arange(n), size[low:high])
                shared = _overlaps(own, tokens[token_at[low] : token_at[high]], n)
                s = size[low:high]
                alike = shared >= threshold * (s[:, None] + s[None, :] - shared) - 1e-9
                np.fill_diagonal(alike, False)
                if one[low] != two[low]:
                    alike &= block[low:high, None] != block[None, low:high]
                if not alike.any():
                    continue
                # A pair counts in the least node that both sets are in.
                mine = leaves[leaf_at[low] : leaf_at[high]]
                less = mine < node[low]
                holder = np.repeat(np.arange(n), np.diff(leaf_at[low : high + 1]))[less]
                alike &= _overlaps(holder, mine[less], n) == 0
                if not alike.any():
                    continue
                label = np.arange(n)
                ranked = np.argsort(np.argsort(rep[low:high]))
                label = ranked.copy()
                while True:
                    near = np.where(alike, label[None, :], n).min(axis=1)
                    better = np.minimum(label, near)
                    if (better == label).all():
                        break
                    label = better
                hit = np.flatnonzero(alike.any(axis=1))
                sorted_rep = np.sort(rep[low:high])
                out_rep.append(rep[low:high][hit])
                out_label.append(sorted_rep[label[hit]])
                out_links.append((alike @ copies[low:high])[hit])
            if out_rep:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in (out_rep, out_label, out_links)],
                    names=["rep", "label", "links"],
                )

    return compare


def _folded(entries: DataFrame) -> DataFrame:
    """(node, rep, n, same) of nodes of two sets at least: nodes of the same members as one; same lists the keys of a large one.

    ``entries`` has node, rep and, where its nodes are folded already, the keys ``same`` of each.
    """
    # Members' hashes are summed twice to tell them apart.
    hashed = [F.sum(F.xxhash64(F.lit(i), F.col("rep")).cast("decimal(38,0)")).alias(f"h{i}") for i in (1, 2)]
    keys = F.any_value("same") if "same" in entries.columns else F.array("node")
    nodes = entries.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *hashed, *([keys.alias("keys")] if "same" in entries.columns else [])).where("n > 1")
    nodes = nodes if "keys" in nodes.columns else nodes.withColumn("keys", keys)
    same = F.flatten(F.collect_list(F.when(F.col("n") > NODE, F.col("keys")))).alias("same")
    nodes = nodes.groupBy("n", "h1", "h2").agg(F.min("node").alias("node"), same).select("node", "n", "same")
    return stored(entries.select("node", "rep").join(stored(nodes, "nodes"), "node").select("node", "rep", "n", "same"), "members")


def _by_size(large: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Members of large nodes divided by size: similar sets are in one class of sizes or in two next to each other."""
    step = F.floor(F.log(F.col("size")) / F.log(F.lit(1 / threshold)) + 1e-9).cast("int")
    sized = large.join(sets.select("rep", "size"), "rep").withColumn("class", step)
    sized = sized.withColumn("class", F.explode(F.array("class", F.col("class") - 1)))
    keyed = F.transform("same", lambda key: F.xxhash64(key, F.col("class")))
    return sized.select(F.xxhash64("node", "class").alias("node"), "rep", keyed.alias("same"))


def _counts(nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(node, pairs, possible, common, n): one row per block of at most some NODE sets of a node, dealt by hash."""
    blocks = F.ceil(F.col("n") / F.lit(NODE)).cast("int")
    block = F.pmod(F.xxhash64(F.lit("count"), "rep", "node"), blocks).cast("int").alias("block")
    held = nodes.select("node", "rep", block).join(sets.select("rep", "tokens"), "rep").select("node", "block", "tokens")
    held = held.mapInArrow(_looker(threshold), "node long, block int, held array<long>")
    held = held.repartition("node", "block").sortWithinPartitions("node", "block")
    return held.mapInArrow(_counter(), "node long, pairs double, possible double, common array<long>, n array<long>")


def _final_nodes(sets: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(node, rep, n) of the nodes to compare: members of nodes of two sets at least, split while large and unlike.

    A node without a child of two sets ends here: that its pairs are missed is part of the loss that the runs make up for.
    """
    small, brief = F.col("n") <= NODE, ("node", "rep", "n")
    final = members.where(small).select(*brief)
    large = members.where(~small)
    if large.isEmpty():
        return final
    divided = _folded(stored(_by_size(large, sets, threshold), "sized"))
    final, large = final.unionByName(divided.where(small).select(*brief)), divided.where(~small)
    for _ in range(DEPTH):
        if large.isEmpty():
            return final
        # Of a set's tokens, the share that another set of the node holds, on average over blocks.
        alike = F.sum("pairs") >= (1 - _spare(threshold) - MARGIN) * F.sum("possible")
        judged = stored(_counts(large, sets, threshold).groupBy("node").agg(alike.alias("alike")), "judged")
        known = stored(large.join(judged, "node"), "known")
        final = final.unionByName(known.where("alike").select(*brief))
        unlike = stored(known.where("not alike").select(F.explode("same").alias("node"), "rep", "n"), "unlike")
        if unlike.isEmpty():
            return final
        # Of a token that a share of COMMON holds, hardly a block holds less than OFTEN.
        held = _counts(unlike, sets, threshold).select("node", F.explode(F.arrays_zip("common", "n")).alias("held"))
        held = held.groupBy("node", F.col("held.common").alias("child")).agg(F.sum("held.n").alias("n"))
        totals = unlike.groupBy("node").agg(F.max("n").alias("sets"))
        common = held.join(totals, "node").where(F.col("n") >= COMMON * F.col("sets"))
        common = stored(common.groupBy("node").agg(F.collect_list("child").alias("common")), "common")
        nothing = F.coalesce("common", F.array().cast("array<long>")).alias("common")
        split = unlike.join(common, "node", "left").join(sets.select("rep", "tokens"), "rep").select("node", "rep", nothing, "tokens")
        children = stored(split.mapInArrow(_splitter(threshold), "rep long, node long").distinct(), "children")
        kept = _folded(children)
        final, large = final.unionByName(kept.where(small).select(*brief)), kept.where(~small)
    return final.unionByName(large.select(*brief))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    seed: int = 0,
) -> DataFrame:
    """One row per document row: doc_id, class_id, n_links, n_shingles, stays, text_hash.

    n_links is the number of other document rows whose shingle set has at least the threshold's
    Jaccard similarity, copies included; class_id is the least doc_id that such links lead to.
    Words are runs of anything but ASCII white space, unchanged. A text of fewer words than a
    shingle is one shingle; null texts and texts without a word link to nothing. Rows are told apart by id and
    text_hash (xxhash64 of the text), so rows of one id, or of none, may hold different texts; a class of null ids alone has
    a null class_id. stays is true for one row of each class (for equal rows, all): that of the least id. Other columns are not read. Pairs are found with probability ``recall`` or more each.
    """
    spark = docs.sparkSession
    runs = _runs(recall)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    schema = "doc_id long, text_hash long, size long, digest string, nodes array<long>"
    widespread = _widespread(source, shingle, threshold)
    rows = stored(source.mapInArrow(_scanner(shingle, threshold, runs, seed, widespread), schema), "rows")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least")
    classes = rows.where("size > 0").groupBy("digest").agg(
        least, F.count(F.lit(1)).alias("copies"), F.max("size").alias("size"), F.any_value("nodes").alias("nodes")
    )
    classes = classes.select("digest", F.col("least.doc_id").alias("first"), F.col("least.text_hash").alias("text_hash"), "copies", "size", "nodes")
    classes = stored(classes, "classes")
    # A class goes by its least id; where that is null, or another class has it too, by a hash of its tokens.
    shared = stored(classes.groupBy("first").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or first is null").select(F.col("first").alias("_first")), "shared")
    plain = shared.isEmpty()
    if plain:
        classes = classes.withColumn("rep", F.col("first"))
    else:
        classes = classes.join(shared, F.col("first").eqNullSafe(F.col("_first")), "left")
        own = F.when(F.col("first").isNull() | F.col("_first").isNotNull(), F.xxhash64("digest")).otherwise(F.col("first"))
        classes = stored(classes.withColumn("rep", own).drop("_first"), "classes")
    entries = classes.select("rep", F.explode(F.array_distinct("nodes")).alias("node"))
    members = _folded(entries)
    place = F.xxhash64("doc_id", "text_hash").alias("place")
    wanted = members.select("rep").distinct().join(classes.select("rep", "copies", "size", F.col("first").alias("doc_id"), "text_hash"), "rep")
    wanted = stored(wanted.select("rep", "copies", "size", place), "wanted")
    tokens = wanted.agg(F.sum("size")).first()[0] or 0
    texts = source.select("text", place).join(wanted.drop("size").hint("shuffle_hash"), "place")
    texts = texts.groupBy("place").agg(*[F.any_value(c).alias(c) for c in ("rep", "copies", "text")])
    sets = bucketed(texts.mapInArrow(_setter(shingle), "rep long, copies long, size long, tokens array<long>"), "rep", "sets", 8 * tokens)
    final = stored(_final_nodes(sets, members, threshold), "final")
    own = final.groupBy("rep").agg(F.collect_set("node").alias("nodes"))
    weights = final.join(classes.select("rep", "size"), "rep").groupBy("node").agg(F.sum("size").alias("weight"), F.count(F.lit(1)).alias("sets"))
    parts = F.ceil(F.greatest(F.col("n") / F.lit(NODE), F.col("weight") / F.lit(NODE_TOKENS))).cast("int")
    dealt = with_group(final, stored(weights, "weights"), "node", "sets", F.xxhash64(F.lit("row"), "rep", "node")).withColumn("parts", parts)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep", "node"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("node", "rep", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    shipped = dealt.join(sets.drop("size").join(own, "rep"), "rep")
    shipped = shipped.select("node", "one", "two", "block", "rep", "copies", "tokens", "nodes")
    shipped = shipped.repartition("node", "one", "two").sortWithinPartitions("node", "one", "two")
    found = stored(shipped.mapInArrow(_comparer(threshold), "rep long, label long, links long"), "found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    grouped = components(found.select(F.col("rep").alias("a"), F.col("label").alias("b")), spark)
    grouped = grouped.select(F.col("node").alias("rep"), "component")
    named = classes.drop("nodes", "size").join(links, "rep", "left").join(grouped, "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    if plain:
        chosen = F.when(F.col("component") == F.col("rep"), F.col("text_hash"))
        named = named.withColumn("class_id", F.col("component")).withColumn("chosen", chosen)
    else:
        named = stored(named, "named")
        least = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "text_hash")).alias("least")
        ids = stored(named.groupBy("component").agg(least, F.count(F.lit(1)).alias("sets")), "ids")
        named = with_group(named, ids, "component", "sets", F.xxhash64(F.lit("row"), "rep"))
        named = named.withColumn("class_id", F.col("least.first")).withColumn("chosen", F.col("least.text_hash"))
    named = stored(named.select("digest", "copies", "links", "class_id", "chosen"), "named")
    out = with_group(rows.drop("nodes"), named, "digest", "copies", F.concat(F.lit("row "), F.col("doc_id").cast("string")))
    grown = F.col("size") > 0
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & F.col("text_hash").eqNullSafe(F.col("chosen"))
    return out.select(
        "doc_id",
        F.when(grown, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(grown, F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.col("size").alias("n_shingles"),
        F.coalesce(~grown | stays, F.lit(False)).alias("stays"),
        "text_hash",
    )
