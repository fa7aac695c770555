"""The trie of conversation prefixes: which turns conversations share from their start on, and what that saves.

Conversations are sorted by their turns over range partitions. Within a partition the edges between sorted neighbours, weighted by
the number of turns that both begin with, go through a union-find from the deepest on: each union makes two components one
branching node, or joins one to the other's. A partition's forest is then contracted to the paths of its first and its last
conversation, for only these can go on in a neighbouring partition; nodes off the paths are done. Paths are merged across boundaries by
the prefixes they stand for: members and minima by grouping, sums over subtrees by adding up what each path owns from its end to its
start.

A conversation is cut into runs of CHUNK turns. Runs after the first are tries of their own under the node where the run before
ended, made from the deepest on and only as far down as conversations share that node; what no other conversation shares is plain. Turns
are ranked over range partitions, so that one conversation may hold any part of all turns. Turns stand as 128-bit digests of role and text.

Null roles and texts are empty. Rows without conv_id belong to no conversation and are left out. Turns of one number, null ones
first, go by the digest of their role and text; repeated rows are turns each. Other columns are ignored. Without conversations there are no
nodes. The identifiers of a node's members that end there go into one hash in their order, which is read as a stream: they take one
task's time, never its memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portflow.llm.shared import SPACES, salted_join, text_of, written

#: Turns of a run; conversations of one block may begin with turns of the block's first, so many at most.
CHUNK, BLOCK, HEADS = 128, 20, 3
#: Hexadecimal digits of a turn's digest.
WIDTH = 32
NOBODY = hashlib.sha256(b"").hexdigest()
_ROWS = ["root", "top", "conv", "seq", "words", "x_children", "x_leaves", "x_saved"]
_FOREST = (
    "open boolean, root string, depth int, conv long, parent_conv long, n long, children long, leaves long, saved long, ends string,"
    " key string, parent_key string, top long, part int, chain int, words long, x_children long, x_leaves long, x_saved long"
)


# ---------------------------------------------------------------- turns


def placed_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, d, t, w): each turn's place in its conversation from 1 on, digest and words; and (conv, size)."""
    role, text = text_of("role"), text_of("text")
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, WIDTH)
    narrow = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", digest.alias("t"), F.regexp_count(text, F.lit(f"[^{SPACES}]+")).alias("w"), F.monotonically_increasing_id().alias("tie")
    )
    dealt = narrow.repartitionByRange("conv", "turn", "t", "tie").withColumn("part", F.spark_partition_id())
    nth = F.row_number().over(Window.partitionBy("part", "conv").orderBy("turn", "t", "tie"))
    ranked = written(dealt.select("conv", "part", "t", "w", nth.alias("nth")))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = ranked.groupBy("conv", "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    offsets = spans.where("before > 0").select("conv", "part", "before")  # one a range partition at most: the conversation that the part goes on with
    turns = ranked.join(F.broadcast(offsets), ["conv", "part"], "left").select("conv", (F.col("nth") + F.coalesce("before", F.lit(0))).cast("long").alias("d"), "t", "w")
    return turns, spans.groupBy("conv").agg(F.sum("n").alias("size"))


def rebuilt_runs(turns: DataFrame, sizes: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(conv, k, seq, words): run k of each rebuilt conversation; and (conv, len), those without turns too."""
    if chunk <= HEADS:
        raise ValueError(f"a run has more than {HEADS} turns")
    first, h = F.pmod("conv", F.lit(BLOCK)) == 0, F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(HEADS + 1))
    base = F.when(~first, F.col("conv") - F.pmod("conv", F.lit(BLOCK)))
    convs = sizes.select("conv", "size", F.when(first, 0).otherwise(h).alias("h"), base.alias("base"))
    lent = sizes.where(first).select(F.col("conv").alias("base"), F.least("size", F.lit(HEADS)).alias("lent"))
    convs = convs.join(lent, "base", "left").withColumn("got", F.least("h", F.coalesce("lent", F.lit(0)))).select("conv", "size", "base", "h", "got")
    heads = turns.where(first & (F.col("d") <= HEADS)).select(F.col("conv").alias("base"), "d", "t", "w")
    copied = convs.where("got > 0").join(heads, "base").where("d <= h").select("conv", F.lit(0).cast("long").alias("k"), "d", "t", "w")
    own = turns.where(first | (F.col("d") > h))
    near = own.where(F.col("d") <= chunk - HEADS).select("conv", F.lit(0).cast("long").alias("k"), "d", "t", "w")
    # where a conversation is long its turns may be many: they meet its one row in salted parts
    moves = convs.where(F.col("size") > chunk - HEADS).select("conv", (F.col("h") - F.col("got")).alias("move"))
    far = salted_join(own.where(F.col("d") > chunk - HEADS), moves, "conv", "d").select("conv", F.expr(f"(d - move - 1) div {chunk}").alias("k"), "d", "t", "w")
    listed = F.sort_array(F.collect_list(F.struct("d", "t", "w"))).alias("x")  # `chunk` turns at most
    runs = copied.unionByName(near).unionByName(far).groupBy("conv", "k").agg(listed)
    runs = runs.select("conv", "k", F.array_join("x.t", "").alias("seq"), F.col("x.w").alias("words"))
    return runs, convs.select("conv", (F.col("got") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("len"))


# ---------------------------------------------------------------- forest of a partition


def _common(a: str, b: str) -> int:
    """The number of turns that both begin with."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    if a[: high * WIDTH] == b[: high * WIDTH]:
        return high
    while high - low > 1:  # a[:low] equals b[:low], a[:high] does not
        middle = (low + high) // 2
        if a[low * WIDTH : middle * WIDTH] == b[low * WIDTH : middle * WIDTH]:
            low = middle
        else:
            high = middle
    return low


class _Forest:
    """The tries of one partition's sorted rows, unary runs contracted: node i hangs on up[i] (-1: it is a root)."""

    def __init__(self, roots: list[str], seqs: list[str], convs: list[int]):
        m = len(seqs)
        self.depth = [len(s) // WIDTH for s in seqs]  # each row's own node first, then those that unions make
        self.up, self.n, self.low, self.row = [-1] * m, [1] * m, list(convs), list(range(m))
        self.ends: list[tuple[int, int] | None] = [(i, i + 1) for i in range(m)]
        self.same = list(range(m))  # nodes that have become one
        self.group, self.head = list(range(m)), list(range(m))  # union-find of rows, and the top node of each component
        edges = [(_common(seqs[i - 1], seqs[i]), -i) for i in range(1, m) if roots[i - 1] == roots[i]]
        for depth, i in sorted(edges, reverse=True):
            self._union(-i - 1, -i, depth)
        for g in range(m):
            if self.group[g] == g and self.depth[top := self.node(self.head[g])] > 0:
                self.up[top] = self._made(0, top)

    def _find(self, i: int) -> int:
        group = self.group
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    def node(self, i: int) -> int:
        same = self.same
        while same[i] != i:
            same[i] = same[same[i]]
            i = same[i]
        return i

    def _made(self, depth: int, over: int) -> int:
        """A new node with the members of `over`."""
        new = len(self.depth)
        for column, value in ((self.depth, depth), (self.up, -1), (self.n, self.n[over]), (self.low, self.low[over]), (self.row, self.row[over]), (self.ends, None), (self.same, new)):
            column.append(value)
        return new

    def _gains(self, node: int, other: int) -> None:
        self.n[node] += self.n[other]
        self.low[node] = min(self.low[node], self.low[other])
        self.row[node] = min(self.row[node], self.row[other])

    def _union(self, left: int, right: int, depth: int) -> None:
        a, b = self._find(left), self._find(right)
        x, y = self.node(self.head[a]), self.node(self.head[b])
        if self.depth[x] > depth and self.depth[y] > depth:  # a branching node over both
            new = self._made(depth, x)
            self._gains(new, y)
            self.up[x] = self.up[y] = x = new
        elif self.depth[x] == depth and self.depth[y] == depth:  # two parts of one node
            self._gains(x, y)
            self.same[y] = x
            if self.ends[y]:
                self.ends[x] = (min(self.ends[x][0], self.ends[y][0]), max(self.ends[x][1], self.ends[y][1])) if self.ends[x] else self.ends[y]
        else:
            x, y = (x, y) if self.depth[x] == depth else (y, x)
            self._gains(x, y)
            self.up[y] = x
        self.group[b] = a
        self.head[a] = x

    def over(self, i: int) -> int:
        return self.node(self.up[i]) if self.up[i] >= 0 else -1

    def path(self, row: int) -> list[int]:
        """The nodes from a row's own up to its root."""
        out = [self.node(row)]
        while (above := self.over(out[-1])) >= 0:
            out.append(above)
        return out


def _key(root: str, depth: int, seq: str) -> str:
    return hashlib.sha256(f"{root}|{depth}|{seq[: depth * WIDTH]}".encode()).hexdigest()[:WIDTH]


def _nodes(part: int, rows: dict[str, list]) -> Iterator[dict]:
    """The nodes of a partition: done ones as they are in the end, those on the paths of its first and last row as parts."""
    roots, seqs, convs, words, tops = (rows[c] for c in ("root", "seq", "conv", "words", "top"))
    f = _Forest(roots, seqs, convs)
    paths = [f.path(0), f.path(len(seqs) - 1)] if len(seqs) > 1 else [f.path(0)]
    opened = set().union(*paths)
    real = [i for i in range(len(f.depth)) if f.same[i] == i]
    kids, leaves, saved = [0] * len(f.depth), [0] * len(f.depth), [0] * len(f.depth)  # of open nodes: without what is open itself

    def extra(i: int) -> tuple:
        """What hangs below a node where a run ends: its members that go on all say the same."""
        found = range(*f.ends[i]) if f.ends[i] and f.depth[i] else ()
        return next(((rows["x_children"][j], rows["x_leaves"][j], rows["x_saved"][j]) for j in found if rows["x_children"][j] is not None), (None, None, None))

    def ending(i: int) -> str:
        """The conversations that end at a node. A run's last node has those that go on among its rows."""
        return ",".join(str(convs[j]) for j in range(*f.ends[i]) if rows["x_children"][j] is None) if f.ends[i] else ""

    def done(i: int, parent: int) -> Iterator[dict]:
        x_children, x_leaves, x_saved = extra(i)
        depth, row, n = f.depth[i], f.row[i], f.n[i]
        children = kids[i] + (x_children or 0)
        leaves[i] = (leaves[i] if kids[i] else 1) if x_leaves is None else x_leaves
        saved[i] += x_saved or 0
        ends = hashlib.sha256(ending(i).encode()).hexdigest()
        last = f.depth[parent] if parent >= 0 else -1
        for d in range(depth, last, -1):
            saved[i] += (n - 1) * words[row][d - 1] if d else 0
            hangs = parent in opened and d == last + 1 and last > 0
            above = None if not d or hangs else tops[row] if d == 1 else f.low[parent] if d == last + 1 else f.low[i]
            yield {
                "open": False, "root": roots[row], "depth": d, "conv": f.low[i], "parent_conv": above, "n": n, "children": children, "leaves": leaves[i], "saved": saved[i],
                "ends": ends, "parent_key": _key(roots[row], last, seqs[row]) if hangs else None,
            }
            children, ends = 1, NOBODY

    for i in sorted(real, key=f.depth.__getitem__, reverse=True):
        parent = f.over(i)
        if i not in opened:
            yield from done(i, parent)
        if parent >= 0:
            kids[parent] += i not in opened
            leaves[parent] += leaves[i]
            saved[parent] += saved[i]
    for chain, path in enumerate(paths):
        for i in path:
            parent, row, first = f.over(i), f.row[i], True
            own = chain == 0 or i not in paths[0]
            x_children, x_leaves, x_saved = extra(i)
            for d in range(f.depth[i], f.depth[parent] if parent >= 0 else -1, -1):
                ends = ending(i) or None if first and own else None
                yield {
                    "open": True, "root": roots[row], "depth": d, "conv": f.low[i] if own else None, "n": f.n[i] if own else 0, "children": kids[i] if own and first else 0,
                    "leaves": leaves[i] if own else 0, "saved": saved[i] if own else 0, "ends": ends, "key": _key(roots[row], d, seqs[row]), "parent_key": _key(roots[row], d - 1, seqs[row]) if d else None,
                    "top": tops[row], "part": part, "chain": chain, "words": words[row][d - 1] if d else 0,
                    "x_children": x_children if first else None, "x_leaves": x_leaves if first else None, "x_saved": x_saved if first else None,
                }
                first = False


def _forest(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows: dict[str, list] = {c: [] for c in _ROWS}
        for batch in batches:
            for c in _ROWS:
                rows[c] += batch.column(c).to_pylist()
        if rows["seq"]:
            held = []
            for node in _nodes(TaskContext.get().partitionId(), rows):
                held.append(node)
                if len(held) == 20_000:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held = []
            yield pa.RecordBatch.from_pylist(held, schema)

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends) of rows sorted by key and part, whose ids are read as one stream for each key."""
    key, hashed = None, None
    for batch in batches:
        for k, ids in zip(batch.column("key"), batch.column("ends"), strict=True):
            k, ids = k.as_py(), ids.as_py().encode()
            if k == key:
                hashed.update(b"," + ids)
                continue
            if key is not None:
                yield pa.record_batch({"key": [key], "ends": [hashed.hexdigest()]})
            key, hashed = k, hashlib.sha256(ids)
    if key is not None:
        yield pa.record_batch({"key": [key], "ends": [hashed.hexdigest()]})


# ---------------------------------------------------------------- trie over partitions

_NODE = ["root", "depth", "conv", "parent_conv", "n", "children", "leaves", "saved", "ends"]


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of all tries in rows (root, top, conv, seq, words, x_children, x_leaves, x_saved): (root, depth, conv, parent_conv, n, children, leaves, saved, ends).

    root tells the tries apart, top is the smallest member of the node a trie hangs on; x_: what is below the node where a row ends.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_FOREST))
    dealt = rows.select(*_ROWS).repartitionByRange("root", "seq", "conv").sortWithinPartitions("root", "seq", "conv")
    forest = written(dealt.mapInArrow(_forest(schema), _FOREST))
    parts, done = forest.where("open"), forest.where("not open")
    sums = {c: F.sum(c) for c in ("n", "children", "leaves", "saved")} | {c: F.max(c) for c in ("words", "x_children", "x_leaves", "x_saved")}
    sums |= {c: F.min(c) for c in ("root", "depth", "parent_key", "top", "conv")} | {"owner": F.min(F.struct("part", "chain"))}
    merged = written(parts.groupBy("key").agg(*(f.alias(c) for c, f in sums.items())))  # twice the partitions times the depth of a run, at most
    below = merged.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("below"))
    merged = merged.join(below, "key", "left").withColumn("children", F.col("children") + F.coalesce("below", F.lit(0)) + F.coalesce("x_children", F.lit(0)))
    own_leaf = F.when(F.col("children") == 0, 1).otherwise(F.coalesce("x_leaves", F.lit(0)))
    merged = merged.withColumns({"own_leaf": own_leaf, "own_saved": (F.col("n") - 1) * F.col("words") + F.coalesce("x_saved", F.lit(0))})
    paths = parts.select("part", "chain", "depth", "key").join(merged.select("key", "owner", "own_leaf", "own_saved"), "key")
    mine = F.col("owner") == F.struct("part", "chain")
    down = Window.partitionBy("part", "chain").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    total = lambda c: F.sum(F.when(mine, F.col(c)).otherwise(0)).over(down)
    under = paths.select("key", total("own_leaf").alias("l"), total("own_saved").alias("s")).groupBy("key").agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    ends = parts.where("ends is not null").select("key", "part", "ends").repartition("key").sortWithinPartitions("key", "part").mapInArrow(_hashed, "key string, ends string")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv").alias("above"))
    spine = merged.join(under, "key").join(ends, "key", "left").join(above, "parent_key", "left").select(
        "root", "depth", "conv", F.when(F.col("depth") == 1, F.col("top")).otherwise(F.col("above")).alias("parent_conv"), "n", "children",
        (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved"), F.coalesce("ends", F.lit(NOBODY)).alias("ends"),
    )
    hanging = salted_join(done.where("parent_key is not null"), above, "parent_key", "conv").withColumn("parent_conv", F.col("above"))
    return done.where("parent_key is null").select(*_NODE).unionByName(hanging.select(*_NODE)).unionByName(spine)


def _plain(runs: DataFrame, chunk: int) -> DataFrame:
    """The nodes of runs that only one conversation has."""
    each = runs.select("conv", "k", F.col("next").isNotNull().alias("more"), F.size("words").alias("len"), F.explode(F.sequence(F.lit(1), F.size("words"))).alias("at"))
    last = (F.col("at") == F.col("len")) & ~F.col("more")
    return each.select(
        (F.col("k") * chunk + F.col("at")).alias("depth"), "conv", F.col("conv").alias("parent_conv"), F.lit(1).cast("long").alias("n"), F.when(last, 0).otherwise(1).cast("long").alias("children"),
        F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"), F.when(last, F.sha2(F.col("conv").cast("string"), 256)).otherwise(NOBODY).alias("ends"),
    )


def prefix_trie(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, sizes = placed_turns(conversations)
    runs, convs = rebuilt_runs(turns, sizes, chunk)
    runs, nothing = written(runs), F.lit(None).cast("long")
    empty = convs.where("len = 0").select("conv", F.lit(0).cast("long").alias("k"), F.lit("").alias("seq"), F.array().cast("array<int>").alias("words"))
    start = runs.where("k = 0").unionByName(empty)
    smallest = convs.agg(F.min("conv")).first()[0]
    below, plain, level, deeper = None, [], 0, runs.where("k > 0")
    if not deeper.isEmpty():
        long_convs = deeper.where("k = 1").select("conv")
        order = Window.partitionBy("conv").orderBy("k")
        so_far = lambda salt: F.sum(F.xxhash64("k", "seq", F.lit(salt)).cast("decimal(38,0)")).over(order.rowsBetween(Window.unboundedPreceding, -1)).cast("string")
        root = F.when(F.col("k") == 0, "").otherwise(F.concat_ws(":", F.col("k").cast("string"), so_far(1), so_far(2)))
        whole = runs.where(F.size("words") == chunk)  # those that end with their first run too: they are members of the node there
        known = whole.where("k = 0").join(long_convs, "conv", "left_anti").unionByName(runs.join(long_convs, "conv", "left_semi")).withColumn("root", root)
        # the node where a whole run ends is named as the run after it would be, were there one
        ending = F.concat_ws(":", (F.col("k") + 1).cast("string"), *((F.coalesce(F.get(F.split("root", ":"), F.lit(i)).cast("decimal(38,0)"), F.lit(0)) + F.xxhash64("k", "seq", F.lit(s))).cast("decimal(38,0)").cast("string") for i, s in ((1, 1), (2, 2))))
        known = known.withColumns({"next": F.lead("k").over(order), "ending": F.when(F.size("words") == chunk, ending)})
        known = written(known)
        nodes = known.where("ending is not null").groupBy(F.col("ending").alias("root")).agg(F.count("*").alias("n"), F.min("conv").alias("top"))
        later = salted_join(known.where("k > 0"), nodes, "root", "conv")
        later = written(later)
        plain = [_plain(later.where("n = 1"), chunk)]
        shared = later.where("n > 1")
        level = shared.agg(F.coalesce(F.max("k"), F.lit(0))).first()[0]
        found = []
        for k in range(level, 0, -1):  # from the deepest run that conversations share
            at = shared.where(F.col("k") == k)
            made = written(trie(_with_below(at, below)))
            below = made.where("depth = 0").select(F.col("root").alias("ending"), F.col("children").alias("c"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
            found.append(made.where("depth > 0").withColumn("depth", F.col("depth") + k * chunk).drop("root"))
        plain += found
        going_on = known.where("k = 0 and next is not null").select("conv", "ending", "next")
        start = start.join(going_on, "conv", "left")
    else:
        start = start.withColumns({"ending": F.lit(None).cast("string"), "next": nothing})
    start = start.withColumns({"root": F.lit(""), "top": F.lit(smallest).cast("long")})
    out = reduce(DataFrame.unionByName, [trie(_with_below(start, below)).drop("root"), *plain])
    return out.select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )


def _with_below(rows: DataFrame, below: DataFrame | None) -> DataFrame:
    """Rows with what hangs below their end: the trie that their conversation goes on in, or a plain run, or nothing."""
    goes_on = F.col("next").isNotNull()
    if below is None:
        c, leaf, s = F.lit(1), F.lit(1), F.lit(0)
    else:
        ends = rows.where(goes_on)
        rest = rows.where(~goes_on).withColumns({x: F.lit(None).cast("long") for x in "cls"})
        known = salted_join(ends, below, "ending", "conv")
        plain = ends.join(below, "ending", "left_anti").withColumns({x: F.lit(None).cast("long") for x in "cls"})
        rows = rest.unionByName(known.select(*rest.columns)).unionByName(plain.select(*rest.columns))
        c, leaf, s = F.coalesce("c", F.lit(1)), F.coalesce("l", F.lit(1)), F.coalesce("s", F.lit(0))
    return rows.withColumns({x: F.when(goes_on, v).cast("long") for x, v in (("x_children", c), ("x_leaves", leaf), ("x_saved", s))})
