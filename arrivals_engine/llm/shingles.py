"""N-gram Jaccard join by a prefix tree over globally ordered shingle sets.

A document's set holds the 64-bit hashes of its distinct 5-word shingles, in the order of the
hashes, which is the same for all documents. Documents of equal sets form a class at once;
classes are linked if 100 * intersection >= 80 * union. How links are found without comparing
all pairs:

1. Two linked sets share at least one of the first n - ceil(0.8 n) + 1 elements of each. The
   prefixes used are longer by ``spare``, so linked sets share that many more of them:
   ``least_shared`` for a partner of any size.
2. Of its prefix a class leaves out the elements that are the commonest, one less than it
   shares with any partner, so it meets each partner at another one. What many texts quote
   is thus left out, unless a text is made of it.
3. Each class is paired with one class of each of its elements only, that with the commonest
   prefix as a whole, so a large group of near copies gives about as many pairs as it has
   members: with the text that they are copies of, or the one that is the nearest to it.
4. Classes that share an element of at most ``hot`` classes, and that are in different
   components so far, are paired. Pairs of both kinds that share too few elements for what is
   left of the sets to make up for it are dropped. For the others, the sets that one class is
   paired with are stored in a radix tree, in chunks of bounded size. Its own set goes down
   the tree once: what several sets begin with is compared once, and a subtree is left as soon
   as the elements left cannot reach the needed intersection.
5. Classes that are connected by other elements are searched in pairs of blocks, without pairing
   blocks of one component. So the work on a group of near copies is the number of those that
   the steps before did not connect times its size. Intersections of two blocks are counted
   all at once, as a product of matrices whose columns are the elements that both have.

All steps are joins and counts on hashed keys; the result is exact, whatever ``hot`` is. Only
classes with enough shared elements have their sets made again and shuffled.

Defined results: documents without words or text have an empty set and no links. Rows with the
same doc_id are linked with one another. A document without doc_id takes part, but no id comes
from it; its component_id is null if no reachable document has one. Other columns are not read.
The set of a very long text is made and held by one task; no documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals_engine.llm.common import UPPER, WORD, Scratch, then_release
from arrivals_engine.llm.components import smallest_reachable

SHINGLE = 5
PERCENT = 80

_TABLE = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes, SipHash with the same key everywhere."""
    cells = np.empty(len(words), object)
    cells[:] = words
    return hash_array(cells, categorize=False)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd multipliers that tell the places in a shingle apart, unrelated to one another.
_PLACES = _mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted hashes of the distinct shingles."""
    # For bytes, split() without arguments splits at the six ASCII white-space characters.
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    if not words:
        return np.zeros(0, np.int64)
    hashes = _word_hashes(words)
    size = min(SHINGLE, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        total += hashes[k : len(words) - size + 1 + k] * _PLACES[k]
    tokens = np.sort(_mixed(total).view(np.int64))
    first = np.ones(len(tokens), bool)
    np.not_equal(tokens[1:], tokens[:-1], out=first[1:])
    return tokens[first]  # which np.unique gives too, more slowly


def signature(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def spare(n: int) -> int:
    """How much longer a prefix is than it needs to be to share one element."""
    return 3 + n // 20


def prefix_size(n: int) -> int:
    return min(n, n - -(-PERCENT * n // 100) + 1 + spare(n)) if n else 0


def needed(a: int, b: int) -> int:
    """The smallest intersection of linked sets of these sizes."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def least_shared(n: int) -> int:
    """The prefix of a set of n elements shares at least so many with that of any linked set.
    For the one of x elements whose prefix ends first, the intersection is at most what the
    prefixes share and x - prefix_size(x), while linked sets share at least 0.8 x."""
    smallest = -(-PERCENT * n // 100)
    if n >= 20:
        return 1 + spare(smallest)
    largest = n * 100 // PERCENT
    sizes = range(max(1, smallest), largest + 1)
    return min(needed(n, b) - (x - prefix_size(x)) for b in sizes for x in (n, b))


class RadixTree:
    """Sorted sets; a node has the elements that all sets below go on with."""

    def __init__(self) -> None:
        self.root: list = [np.zeros(0, np.int64), {}, [], 0]  # run, children, names, longest below

    def add(self, tokens: np.ndarray, name: int) -> None:
        node, at = self.root, 0
        while True:
            node[3] = max(node[3], len(tokens) - at)
            if at == len(tokens):
                node[2].append((name, len(tokens)))
                return
            child = node[1].get(int(tokens[at]))
            if child is None:
                rest = tokens[at:]
                node[1][int(rest[0])] = [rest, {}, [(name, len(tokens))], 0]
                return
            run = child[0]
            m = min(len(run), len(tokens) - at)
            differ = np.flatnonzero(run[:m] != tokens[at : at + m])
            same = int(differ[0]) if len(differ) else m
            if same < len(run):
                lower = [run[same:], child[1], child[2], child[3]]
                child[:] = [run[:same], {int(run[same]): lower}, [], len(run) - same + child[3]]
            node, at = child, at + same

    def linked(self, tokens: np.ndarray) -> list[int]:
        """The names of the sets that are linked with this one."""
        n, found = len(tokens), []
        least = -(-PERCENT * n // 100)  # of the intersection, for a partner of any size
        todo = [(self.root, 0, 0, 0)]
        while todo:
            node, at, depth, shared = todo.pop()
            run = node[0]
            if len(run):
                # in one sorted run each element is met once
                places = np.searchsorted(tokens[at:], run)
                hit = places < n - at
                shared += int((tokens[at:][places[hit]] == run[hit]).sum())
                at += int(np.searchsorted(tokens[at:], run[-1], side="right"))
                depth += len(run)
            for name, size in node[2]:
                if shared >= needed(n, size):
                    found.append(name)
            # what is left of either side bounds what can still be shared
            if shared + min(n - at, node[3]) >= least:
                todo += [(child, at, depth, shared) for child in node[1].values()]
        return found


#: Cells of a matrix that ``shared_counts`` makes at a time.
CELLS = 2**20


def shared_counts(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """How many elements each set of left has in common with each one of right; without right,
    with each other one of left, the diagonal being of no use."""
    sets = [*left, *(right or ())]
    tokens = np.concatenate(sets)
    order = np.argsort(tokens)
    tokens = tokens[order]
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order]
    starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    times = np.diff(starts, append=len(tokens))
    if right is None:
        wanted = times > 1
    else:
        first, last = np.minimum.reduceat(rows, starts), np.maximum.reduceat(rows, starts)
        wanted = (first < len(left)) & (last >= len(left))
    keep = np.repeat(wanted, times)
    rows, columns = rows[keep], np.repeat(np.cumsum(wanted) - 1, times)[keep]
    n = int(wanted.sum())
    width = max(1, CELLS // len(sets))
    counts = np.zeros((len(left), len(right or left)), np.int64)
    for start in range(0, n, width):
        a, b = np.searchsorted(columns, [start, start + width])
        has = np.zeros((len(sets), min(width, n - start)), np.float32)
        has[rows[a:b], columns[a:b] - start] = 1
        # Sums of at most ``width`` ones, which float32 holds exactly.
        counts += (has[: len(left)] @ has[len(left) if right else 0 :].T).astype(np.int64)
    return counts


SETS = (
    "doc_id long, rep string, n long, sig binary, prefix array<long>, least long, last long"
)


def _rep(docs: DataFrame) -> Column:
    """The name of a document, also where it has no id."""
    doc_id = docs["doc_id"].cast("long")
    return F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(docs["text"], F.lit(""))))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), _rep(docs).alias("rep"), "text")


def _sets(docs: DataFrame) -> DataFrame:
    @then_release
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for text in rows["text"]:
                tokens = shingle_set(text)
                n = len(tokens)
                prefix = tokens[: prefix_size(n)]
                last = int(prefix[-1]) if n else 0
                out.append((n, signature(tokens), prefix, least_shared(n) if n else 0, last))
            frame = pd.DataFrame(out, columns=["n", "sig", "prefix", "least", "last"])
            yield pd.concat([rows[["doc_id", "rep"]].astype({"doc_id": "Int64"}), frame], axis=1)

    return _texts(docs).mapInPandas(make, SETS)


def _whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, tokens) of wanted classes (node, sig, rep), made again from the text of rep."""

    @then_release
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            nodes, sets = [], []
            for node, sig, text in zip(rows["node"], rows["sig"], rows["text"], strict=True):
                tokens = shingle_set(text)
                if signature(tokens) == bytes(sig):
                    nodes.append(node)
                    sets.append(tokens)
            yield pd.DataFrame({"node": np.array(nodes, np.int64), "tokens": sets})

    texts = _texts(docs).join(wanted, "rep").select("node", "sig", "text")
    return texts.mapInPandas(make, "node long, tokens array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, chunk: int) -> DataFrame:
    """Those of pairs (a, b) that are linked."""

    @then_release
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for a, mine, others in _groups(batches, chunk):
            tree = RadixTree()
            for name, tokens in others.items():
                tree.add(tokens, name)
            found = tree.linked(mine)
            yield pd.DataFrame({"a": np.full(len(found), a), "b": np.array(found, np.int64)})

    one = sets.dropDuplicates(["node"])
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / (4 * chunk)).alias("parts"))
    numbered = pairs.join(parts, "a").select(
        "a", F.pmod(F.xxhash64("b"), "parts").alias("part"), "b"
    )
    asked = numbered.select("a", "part").distinct().withColumn("b", F.lit(None).cast("long"))
    # Behind its own set, the smallest b being null, come the sets a class is paired with.
    rows = (
        numbered.unionByName(asked)
        .withColumn("of", F.coalesce("b", "a"))
        .join(one, F.col("of") == F.col("node"))
        .select("a", "part", "b", "tokens")
    )
    return (
        rows.repartition("a", "part")
        .sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
        .mapInPandas(search, "a long, b long")
    )


def _groups(batches: Iterator[pd.DataFrame], chunk: int):
    """(a, its set, {b: set}) from sorted rows, with at most chunk sets at a time."""
    a = mine = None
    others: dict[int, np.ndarray] = {}
    for rows in batches:
        for left, right, tokens in zip(rows["a"], rows["b"], rows["tokens"], strict=True):
            if right is None or right != right:
                if others:
                    yield a, mine, others
                a, mine, others = int(left), np.asarray(tokens), {}
                continue
            others[int(right)] = np.asarray(tokens)
            if len(others) == chunk:
                yield a, mine, others
                others = {}
    if others:
        yield a, mine, others


def _enough(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Of (a, b, shared) those pairs that may be linked: ``shared`` elements of both prefixes,
    and at most as many more as one of the two has left out."""
    side = lambda s: classes.select(
        F.col("node").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n", "size", "last", "n_out"))
    )
    rows = shared.join(side("a"), "a").join(side("b"), "b")
    rest_a, rest_b = F.col("n_a") - F.col("size_a"), F.col("n_b") - F.col("size_b")
    rest = (
        F.when(F.col("last_a") < F.col("last_b"), rest_a)
        .when(F.col("last_a") > F.col("last_b"), rest_b)
        .otherwise(F.least(rest_a, rest_b))
    )
    most = F.col("shared") + F.greatest("n_out_a", "n_out_b") + rest
    enough = most * (100 + PERCENT) >= (F.col("n_a") + F.col("n_b")) * PERCENT
    alike = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    return rows.where(enough & alike).select("a", "b")


def components(
    docs: DataFrame, *, hot: int = 32, chunk: int = 64, block: int = 256
) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of docs."""
    return _members(docs, hot, chunk, block).select("doc_id", "n_shingles", "component_id")


def _members(docs: DataFrame, hot: int, chunk: int, block: int) -> DataFrame:
    """The same with rep, and part, which is the same number for all of a component."""
    scratch = Scratch(docs.sparkSession, "shingles")
    made = scratch.put(_sets(docs), "sets")
    each = scratch.put(made.select("doc_id", "rep", "n", "sig"), "docs")
    classes = scratch.put(_classes(made), "classes")
    rows = made.select("rep", "sig", "prefix").join(
        classes.select("rep", "sig", "node"), ["rep", "sig"]
    )
    rows = rows.dropDuplicates(["node"]).select("node", F.explode("prefix").alias("token"))
    rows = scratch.put(rows, "prefixes")
    scratch.drop("sets")

    counts = rows.groupBy("token").count().where(F.col("count") > 1)
    shared = rows.join(counts, "token").select("node", "token", "count")
    shared = scratch.put(shared, "shared")
    scratch.drop("prefixes")
    used, able = _search_space(shared, classes, hot, scratch)
    scratch.drop("shared")
    sets = scratch.put(_whole_sets(docs, able.select("node", "sig", "rep")), "able_sets")

    # The leader of an element is the class whose prefix is the most common: the text that
    # others are copies of, rather than one of the copies.
    leaders = used.groupBy("token").agg(
        F.max_by("node", F.struct("weight", -F.col("node"))).alias("a")
    )
    stars = (
        used.join(leaders, "token")
        .where(F.col("node") != F.col("a"))
        .groupBy("a", F.col("node").alias("b"))
        .agg(F.count("*").alias("shared"))
    )
    links = scratch.put(_verified(_enough(stars, able), sets, chunk), "links_1")
    label = smallest_reachable(links, scratch, "star")
    across = _enough(_across(used, label, scratch), able)
    links = links.unionByName(scratch.put(_verified(across, sets, chunk), "links_2"))
    label = smallest_reachable(links, scratch, "more")
    in_blocks = _linked_in_blocks(_blocks(used, label, able, scratch, block), sets)
    links = links.unionByName(scratch.put(in_blocks, "links_3")).unionByName(_same_id(each, classes))
    scratch.drop("able_sets", "used")
    return _named(each, classes, smallest_reachable(links, scratch, "all"))


def _classes(made: DataFrame) -> DataFrame:
    """A row for each different set that is not empty."""
    return (
        made.where(F.col("n") > 0)
        .groupBy("sig")
        .agg(
            F.min("rep").alias("rep"),
            F.min("doc_id").alias("smallest_id"),
            *(F.max(c).alias(c) for c in ("n", "least", "last")),
            F.max(F.size("prefix").cast("long")).alias("size"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )


def _search_space(shared: DataFrame, classes: DataFrame, hot: int, scratch: Scratch):
    """The (node, token, hot, weight) that the search goes by, and the classes that may have
    links at all. ``limit``: elements of more classes are left out; n_out is their number."""
    per_node = shared.groupBy("node").agg(
        F.sort_array(F.collect_list("count"), asc=False).alias("counts"),  # as many as its prefix
        F.sum("count").alias("common"),
    )
    able = (
        classes.join(per_node, "node")
        # Over the whole prefix: else a copy that has lost the rarer elements of its text, and
        # has others that are its own instead, would seem the more common of the two.
        .withColumn("weight", F.col("common") / F.col("size"))
        .where(F.size("counts") >= F.col("least"))
        .withColumn("limit", F.element_at("counts", F.col("least").cast("int")))
        .withColumn("n_out", F.size(F.filter("counts", lambda x: x > F.col("limit"))))
        .drop("counts", "common")
    )
    able = scratch.put(able, "able")
    kept = shared.join(able.select("node", "limit", "weight"), "node")
    kept = kept.where(F.col("count") <= F.col("limit")).select("node", "token", "weight")
    kept = scratch.put(kept, "kept")
    counts = kept.groupBy("token").count().where(F.col("count") > 1)
    used = kept.join(counts, "token").select(
        "node", "token", (F.col("count") > hot).alias("hot"), "weight"
    )
    used = scratch.put(used, "used")
    scratch.drop("kept")
    return used, able


def _part(rows: DataFrame, label: DataFrame, name: str) -> DataFrame:
    """rows with the component, so far, of each node."""
    label = label.select(F.col("id").alias("node"), F.col("smallest").alias(name))
    return rows.join(label, "node", "left").withColumn(name, F.coalesce(name, "node"))


def _across(used: DataFrame, label: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, shared) of classes that share an element which is not hot and that are in
    different components. At most ``hot`` for each row."""
    named = _part(used.where(~F.col("hot")).select("token", "node"), label, "part")
    span = named.groupBy("token").agg(F.min("part").alias("p"), F.max("part").alias("q"))
    mixed = span.where(F.col("p") < F.col("q")).select("token")
    named = scratch.put(named.join(mixed, "token"), "mixed")
    left = named.select("token", F.col("node").alias("a"), F.col("part").alias("part_a"))
    right = named.select("token", F.col("node").alias("b"), F.col("part").alias("part_b"))
    return (
        left.join(right, "token")
        .where((F.col("a") < F.col("b")) & (F.col("part_a") != F.col("part_b")))
        .groupBy("a", "b")
        .agg(F.count("*").alias("shared"))
    )


def _blocks(
    used: DataFrame, label: DataFrame, able: DataFrame, scratch: Scratch, block: int
) -> DataFrame:
    """(blocks, side, node, part): pairs of blocks of classes that hot elements connect, each
    class in one block of about so many classes of mean size. A large component has blocks of
    its own, which are not paired with one another; small ones are put together."""
    hot = used.where(F.col("hot")).select("token", "node")
    first = hot.groupBy("token").agg(F.min("node").alias("a"))
    edges = hot.join(first, "token").select("a", F.col("node").alias("b")).distinct()
    groups = smallest_reachable(scratch.put(edges, "hot_edges"), scratch, "hot")
    nodes = _part(_part(edges.select(F.col("b").alias("node")).distinct(), groups, "group"), label, "part")
    # A class counts for one, or for as much as its set is longer than 2000 elements.
    nodes = nodes.join(able.select("node", F.greatest(F.lit(1.0), F.col("n") / 2000).alias("of")), "node")
    sizes = nodes.groupBy("group", "part").agg(F.sum("of").alias("n"))
    large = F.col("n") >= block
    pools = sizes.groupBy("group").agg(
        F.sum(F.when(~large, F.col("n")).otherwise(0)).alias("pool"), F.count("*").alias("parts")
    )
    dealt = (
        nodes.join(sizes, ["group", "part"])
        .join(pools.where(F.col("parts") > 1), "group")
        .select(
            "group",
            "node",
            "part",
            F.when(large, F.col("part")).alias("own"),
            F.when(large, F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / block)))
            .otherwise(F.pmod(F.xxhash64("part"), F.ceil(F.greatest("pool", F.lit(1)) / block)))
            .alias("k"),
        )
        .withColumn("block", F.concat_ws("/", F.coalesce("own", F.lit(-1)), "k"))
    )
    dealt = scratch.put(dealt, "blocks")
    kinds = dealt.select("group", "block", "own").distinct()
    one = kinds.select("group", F.col("block").alias("p"), F.col("own").alias("own_p"))
    two = kinds.select("group", F.col("block").alias("q"), F.col("own").alias("own_q"))
    pairs = one.join(two, "group").where(
        (F.col("p") <= F.col("q")) & ~F.coalesce(F.col("own_p") == F.col("own_q"), F.lit(False))
    )
    named = pairs.select("group", "p", "q", F.concat_ws(" ", "group", "p", "q").alias("blocks"))
    left = named.select("group", F.col("p").alias("block"), F.lit(0).alias("side"), "blocks")
    right = named.where(F.col("p") != F.col("q")).select(
        "group", F.col("q").alias("block"), F.lit(1).alias("side"), "blocks"
    )
    return dealt.join(left.unionByName(right), ["group", "block"]).select(
        "blocks", "side", "node", "part"
    )


def _linked_in_blocks(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the linked pairs (a, b) in each pair of blocks as many as join its components."""

    @then_release
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for members in _by_blocks(batches):
            yield pd.DataFrame(_joining(members), columns=["a", "b"], dtype=np.int64)

    return (
        rows.join(sets.dropDuplicates(["node"]), "node")
        .repartition("blocks")
        .sortWithinPartitions("blocks", "side", "node")
        .mapInPandas(search, "a long, b long")
    )


def _joining(members: list[tuple]) -> list[tuple[int, int]]:
    """As many linked nodes (a, b) of the (side, node, part, tokens) as join their parts. If there
    are two sides, b is of the other one."""
    left = [m for m in members if m[0] == 0]
    right = [m for m in members if m[0] == 1] or left
    if not left:
        return []
    counts = shared_counts([m[3] for m in left], None if right is left else [m[3] for m in right])
    sizes = np.add.outer([len(m[3]) for m in left], [len(m[3]) for m in right])
    linked = counts * (100 + PERCENT) >= sizes * PERCENT
    parts, others = (np.array([m[2] for m in side], np.int64) for side in (left, right))
    found = []
    for k, row in enumerate(linked):
        mine = parts[k]
        near = np.flatnonzero(row & (others != mine))
        if len(near):
            joined, first = np.unique(others[near], return_index=True)
            found += [(left[k][1], right[j][1]) for j in near[first]]
            parts[np.isin(parts, joined)] = mine
            others[np.isin(others, joined)] = mine
    return found


def _by_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    """The (side, node, part, tokens) of one pair of blocks after the other."""
    now, members = None, []
    for rows in batches:
        for blocks, side, node, part, tokens in rows[
            ["blocks", "side", "node", "part", "tokens"]
        ].itertuples(index=False):
            if blocks != now and members:
                yield members
                members = []
            now = blocks
            members.append((side, int(node), int(part), np.asarray(tokens)))
    if members:
        yield members


def _same_id(each: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes that documents with the same id are in."""
    ids = each.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)).select("doc_id", "sig")
    several = ids.groupBy("doc_id").agg(F.min("sig").alias("p"), F.max("sig").alias("q"))
    several = several.where(F.col("p") != F.col("q")).select("doc_id", "p")
    node = lambda sig, name: classes.select(F.col("sig").alias(sig), F.col("node").alias(name))
    return (
        ids.join(several, "doc_id")
        .where(F.col("sig") != F.col("p"))
        .join(node("p", "a"), "p")
        .join(node("sig", "b"), "sig")
        .select("a", "b")
    )


def _named(each: DataFrame, classes: DataFrame, label: DataFrame) -> DataFrame:
    parts = classes.join(label, F.col("node") == label["id"], "left").select(
        "sig", "smallest_id", F.coalesce("smallest", "node").alias("part")
    )
    ids = parts.groupBy("part").agg(F.min("smallest_id").alias("component_id"))
    by_sig = parts.join(ids, "part").select("sig", "component_id", "part")
    return each.join(by_sig, "sig", "left").select(
        "doc_id",
        "rep",
        "part",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(
    docs: DataFrame, *, hot: int = 32, chunk: int = 64, block: int = 256
) -> DataFrame:
    """docs with one document of each component: that with the smallest id, of which all repeated
    rows stay; where none has an id, one row of the text with the smallest digest. Texts
    without words stay."""
    rows = _members(docs, hot, chunk, block).where(F.col("n_shingles") > 0)
    with_id = F.col("doc_id").isNotNull()
    first = rows.groupBy("part").agg(F.min(F.when(~with_id, F.col("rep"))).alias("first"))
    others = rows.where(~with_id).join(first, "part")
    gone = (
        rows.where(with_id & (F.col("doc_id") != F.col("component_id")))
        .select("rep")
        .unionByName(
            others.where(
                F.col("component_id").isNotNull() | (F.col("rep") != F.col("first"))
            ).select("rep")
        )
    )
    gone = gone.select(F.col("rep").alias("_gone")).distinct()
    kept = docs.join(gone, _rep(docs) == gone["_gone"], "left_anti")
    if docs.where(docs["doc_id"].isNull()).isEmpty():
        return kept
    nameless = docs["doc_id"].isNull() & F.coalesce(docs["text"].rlike(WORD), F.lit(False))
    return kept.where(~nameless).unionByName(kept.where(nameless).dropDuplicates(["text"]))
