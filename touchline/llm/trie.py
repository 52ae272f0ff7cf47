"""The trie of conversations, as balanced parentheses of sorted shards.

Conversations are sorted by their turns and dealt by ranges, so that a shard is a contiguous
piece of the trie. A shard's trie is a sequence of parentheses; a node's subtree ends where
its parenthesis is closed, which a range min-max tree over the excess finds. Only the nodes
on the paths of a shard's first and last conversation, its spines, can also be in other
shards. What a shard knows of them is one record for each spine, and records of all shards
are sorted and built into tries in the same way, until one shard is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import Scratch, lists

#: Turns and records after which a shard ends; it has this many records at least, so that
#: two spines are fewer than what they stand for, however long one record is.
SHARD_TURNS, SHARD_RECORDS = 1 << 16, 16
#: Steps of excess in a block, and blocks or nodes under one node of the tree over them.
BLOCK, FAN = 64, 16
#: Bytes of a turn's digest.
TURN = 16
NEVER = np.iinfo(np.int64).max

WORD = r"[^\x20\x09-\x0D]+"
NODES = {
    "conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(),
    "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "ends_sha256": pa.string(),
}
#: Of a spine by depth: words of its turns and what is known of the subtree beside the spine.
SUMS = ("words", "convs", "least", "kids", "leaves", "saved")
SCHEMA = pa.schema(
    [
        ("kind", pa.string()),
        ("shard", pa.string()),
        ("name", pa.binary()),
        ("parent", pa.binary()),
        *NODES.items(),
        ("path", pa.binary()),
        *[(x, pa.list_(pa.int64())) for x in SUMS],
        ("ids", pa.string()),
    ]
)


class Parentheses:
    """A trie in preorder, from the depths of its nodes: ``(`` opens a node, ``)`` closes it."""

    def __init__(self, depth: np.ndarray) -> None:
        n = len(depth)
        # Before a node opens, all open ones of its depth or more are closed.
        closed = np.r_[0, depth[:-1] - depth[1:] + 1]
        self.open = np.arange(n) + np.cumsum(closed)
        size = 2 * n
        step = np.full(size, -1, np.int64)
        step[self.open] = 1
        self.excess = np.cumsum(step)
        self.rank = np.cumsum(step > 0)
        self._tree = [self._least(self.excess, BLOCK)]
        while len(self._tree[-1]) > 1:
            self._tree.append(self._least(self._tree[-1], FAN))

    @staticmethod
    def _least(values: np.ndarray, width: int) -> np.ndarray:
        return np.minimum.reduceat(values, np.arange(0, len(values), width))

    @staticmethod
    def _first(values: np.ndarray, start: np.ndarray, width: int, most: np.ndarray) -> np.ndarray:
        """The first place from ``start`` within its run of ``width`` values whose value is at
        most ``most``; -1 if there is none."""
        out = np.full(len(start), -1)
        for part in range(0, len(start), 1 << 14):
            of = slice(part, part + (1 << 14))
            places = (start[of] // width * width)[:, None] + np.arange(width)
            held = values[np.minimum(places, len(values) - 1)]
            hit = (places >= start[of, None]) & (places < len(values)) & (held <= most[of, None])
            out[of] = np.where(hit.any(axis=1), places[:, 0] + hit.argmax(axis=1), -1)
        return out

    def find_close(self) -> np.ndarray:
        """Where each node is closed: the first place behind it with less excess than it has.

        It is looked for in the node's own block, then up the tree over the blocks until a later
        one falls so low, and down again.
        """
        most = self.excess[self.open] - 1
        found = self._first(self.excess, self.open, BLOCK, most)
        left = np.flatnonzero(found < 0)
        at, width = self.open[left], BLOCK
        level_of, place_of = np.zeros(len(self.open), np.int64), np.zeros(len(self.open), np.int64)
        for level, values in enumerate(self._tree):
            at = at // width + 1
            inside = at % FAN != 0
            hit = np.full(len(left), -1)
            hit[inside] = self._first(values, at[inside], FAN, most[left[inside]])
            done = hit >= 0
            level_of[left[done]], place_of[left[done]] = level, hit[done]
            # The run ended without it: go on behind the parent, whose last place that is.
            at, left, width = at[~done] - 1, left[~done], FAN
            if not len(left):
                break
        for level in range(len(self._tree) - 1, -1, -1):
            here = np.flatnonzero((found < 0) & (level_of >= level))
            if not len(here):
                continue
            below = self._tree[level - 1] if level else self.excess
            fan = FAN if level else BLOCK
            place_of[here] = self._first(below, place_of[here] * fan, fan, most[here])
            if not level:
                found[here] = place_of[here]
        return found


def subtree_least(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The least of ``size`` values from each place on, with runs of doubling lengths."""
    out, run, level = values.copy(), values, 0
    power = np.frexp(size.astype(float))[1] - 1
    while True:
        at = np.flatnonzero(power == level)
        out[at] = np.minimum(run[at], run[at + size[at] - (1 << level)])
        if level >= power.max(initial=0):
            return out
        run = np.minimum(run[: len(run) - (1 << level)], run[1 << level :])
        level += 1


def common(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common from the start."""
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * TURN : middle * TURN] == b[low * TURN : middle * TURN]:
            low = middle
        else:
            high = middle - 1
    return low


def names_of(path: bytes) -> list[bytes]:
    """A name for each prefix of a path, by a chain of digests."""
    name = hashlib.md5(b"root").digest()
    out = [name]
    for at in range(0, len(path), TURN):
        name = hashlib.md5(name + path[at : at + TURN]).digest()
        out.append(name)
    return out


class Shard:
    """Records, sorted by path, of a contiguous piece of the trie.

    A record has a path and, by depth, its words and what is known already of the nodes on it.
    A conversation is such a record, with itself as the only thing known, at its end.
    """

    def __init__(self) -> None:
        self.paths: list[bytes] = []
        self.sums: list[list[np.ndarray]] = []
        self.ids: list[int] = []
        self.turns = 0

    def add(self, path: bytes, sums: list[np.ndarray], conv_id: int | None) -> None:
        self.paths.append(path)
        self.sums.append(sums)
        if conv_id is not None:
            self.ids.append(conv_id)
        self.turns += len(path) // TURN + 1

    def full(self) -> bool:
        return self.turns >= SHARD_TURNS and len(self.paths) >= SHARD_RECORDS

    def _nodes(self) -> None:
        """Nodes in preorder: depth, parent, the sums of the records through them, and the end
        node of each record."""
        parents, starts, stack, ends, depths = [], [], [-1], [], []
        n, last = 0, b""
        places: list[np.ndarray] = []
        for i, path in enumerate(self.paths):
            turns = len(path) // TURN
            shared = common(last, path) if i else -1
            new = turns - shared
            del stack[shared + 2 :]
            parents.append(np.r_[stack[-1], np.arange(n, n + new - 1)][:new])
            starts.append(shared + 1)
            depths.append(np.arange(shared + 1, turns + 1))
            stack.extend(range(n, n + new))
            n, last = n + new, path
            ends.append(stack[-1])
            places.append(np.array(stack[1:], np.int64))
            if i == 0:
                self.first = places[0]
        self.last = places[-1]
        self.parent, self.depth = np.concatenate(parents).astype(np.int64), np.concatenate(depths)
        self.end = np.array(ends)
        flat = np.concatenate(places)
        self.sum = {}
        for x, name in enumerate(SUMS):
            values = np.concatenate([s[x] for s in self.sums])
            total = np.full(n, NEVER) if name == "least" else np.zeros(n, np.int64)
            if name == "words":
                total[flat] = values
            elif name == "least":
                np.minimum.at(total, flat, values)
            else:
                np.add.at(total, flat, values)
            self.sum[name] = total

    def solve(self, shard: str, whole: bool) -> dict[str, list]:
        """Rows of SCHEMA: the nodes of this shard alone, spines, and ids that end on them.

        With ``whole`` no other shard has its nodes.
        """
        self._nodes()
        n, kids = len(self.depth), self.sum["kids"].copy()
        tree = Parentheses(self.depth)
        close = tree.find_close()
        size = (close - tree.open + 1) // 2
        stop = np.arange(n) + size

        def under(values: np.ndarray) -> np.ndarray:
            """The sum over each node's subtree, from a cumulative array."""
            total = np.r_[0, np.cumsum(values)]
            return total[stop] - total[:n]

        kids += np.bincount(self.parent[1:], minlength=n)
        convs, least = under(self.sum["convs"]), subtree_least(self.sum["least"], size)
        own = (convs - 1) * self.sum["words"]
        # A leaf is a pair of parentheses side by side, if nothing else is known under it.
        pairs = (close == tree.open + 1) & (kids == 0)
        leaves = under(pairs + self.sum["leaves"])
        saved = under(own + self.sum["saved"])

        spine = np.zeros(n, bool)
        if not whole:
            spine[self.first] = spine[self.last] = True
        first, last = (names_of(self.paths[i]) for i in (0, -1))
        name = [None] * n
        for places, names in ((self.first, first), (self.last, last)):
            for at, x in zip(places.tolist(), names, strict=True):
                name[at] = x
        rows: dict[str, list] = {x: [] for x in SCHEMA.names}

        def put(count: int, **columns: list) -> None:
            for x in rows:
                rows[x].extend(columns.get(x, [None] * count))

        hashes = self._ends(spine)
        inner = np.flatnonzero(~spine)
        if len(inner):
            over = self.parent[inner]
            outside = (over < 0) | spine[over]
            put(
                len(inner),
                kind=["node"] * len(inner),
                shard=[shard] * len(inner),
                name=self._names(inner) if not self.ids else [None] * len(inner),
                parent=[name[p] if o and p >= 0 else None for p, o in zip(over.tolist(), outside.tolist(), strict=True)],
                conv_id=least[inner].tolist(),
                depth=self.depth[inner].tolist(),
                parent_conv_id=[None if o else int(least[p]) for p, o in zip(over.tolist(), outside.tolist(), strict=True)],
                n_convs=convs[inner].tolist(),
                n_children=kids[inner].tolist(),
                n_leaves=leaves[inner].tolist(),
                saved_tokens=saved[inner].tolist(),
                ends_sha256=[hashes.get(i) for i in inner.tolist()],
            )
        if whole:
            return rows
        for i, ids in self._spine_ends:
            put(1, kind=["ids"], shard=[shard], name=[name[i]], conv_id=[ids[0]], ids=[",".join(map(str, ids))])
        self._put_spines(put, shard, spine, kids, convs, least, leaves, saved)
        return rows

    def _names(self, inner: np.ndarray) -> list[bytes]:
        """Names of nodes, from their parents' names; only records of spines need them."""
        name = [b""] * len(self.depth)
        turn = [b""] * len(self.depth)
        for i, path in enumerate(self.paths):
            at = int(self.end[i])
            for d in range(len(path) // TURN, 0, -1):
                if turn[at]:
                    break
                turn[at] = path[(d - 1) * TURN : d * TURN]
                at = int(self.parent[at])
        for i, p in enumerate(self.parent.tolist()):
            name[i] = hashlib.md5(name[p] + turn[i] if p >= 0 else b"root").digest()
        return [name[i] for i in inner.tolist()]

    def _ends(self, spine: np.ndarray) -> dict[int, str]:
        """The hash of the ids that end at each node; those on spines are kept for later."""
        self._spine_ends: list[tuple[int, list[int]]] = []
        hashes: dict[int, str] = {}
        if not self.ids:
            return hashes
        starts = np.flatnonzero(np.r_[True, self.end[1:] != self.end[:-1]])
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(self.end)], strict=True):
            node, ids = int(self.end[a]), self.ids[a:b]
            if spine[node]:
                self._spine_ends.append((node, ids))
            else:
                hashes[node] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        return hashes

    def _put_spines(self, put, shard, spine, kids, convs, least, leaves, saved) -> None:  # noqa: ANN001
        """A record for the first path, and one for what the last path has beyond it."""
        beside = np.flatnonzero(~spine)
        top = beside[spine[self.parent[beside]]]
        known = {x: self.sum[x].copy() for x in SUMS}
        over = self.parent[top]
        np.add.at(known["convs"], over, convs[top])
        np.minimum.at(known["least"], over, least[top])
        np.add.at(known["leaves"], over, leaves[top])
        np.add.at(known["saved"], over, saved[top])
        np.add.at(known["kids"], over, 1)
        shared = common(self.paths[0], self.paths[-1]) + 1
        for places, path, skip in (
            (self.first, self.paths[0], 0),
            (self.last, self.paths[-1], shared),
        ):
            if skip == len(places):
                continue
            columns = {}
            for x in SUMS:
                values = known[x][places]
                if x != "words":
                    values[:skip] = NEVER if x == "least" else 0
                columns[x] = [values.tolist()]
            put(1, kind=["spine"], shard=[shard], path=[path], **columns)


def _conversation(turns: int, conv_id: int, words: np.ndarray) -> list[np.ndarray]:
    """The sums of a conversation that nothing else is known of."""
    none = np.zeros(turns + 1, np.int64)
    end = none.copy()
    end[-1] = 1
    least = np.full(turns + 1, NEVER)
    least[-1] = conv_id
    return [np.r_[0, words], end, least, none, none, none]


def _solve(number: int, spines: bool, whole: bool):  # noqa: ANN202
    """A function over sorted record batches that cuts them into shards and solves each."""

    def batches(found: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(found, schema=SCHEMA)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, shard = TaskContext.get().partitionId(), 0, Shard()
        for batch in rows:
            paths = batch.column("path").to_pylist()
            if spines:
                sums = list(zip(*[lists(batch.column(x)) for x in SUMS], strict=True))
                records = [(p, list(s), None) for p, s in zip(paths, sums, strict=True)]
            else:
                ids = batch.column("conv_id").to_pylist()
                words = lists(batch.column("words"))
                records = [
                    (p, _conversation(len(p) // TURN, i, w), i)
                    for p, i, w in zip(paths, ids, words, strict=True)
                ]
            for record in records:
                shard.add(*record)
                if shard.full() and not whole:
                    yield batches(shard.solve(f"{number}-{part}-{count}", whole))
                    shard, count = Shard(), count + 1
        if shard.paths:
            yield batches(shard.solve(f"{number}-{part}-{count}", whole))

    return run


def rebuilt(turns: DataFrame, heads_of: Column, keep: Column) -> DataFrame:
    """conv_id, path (digests of turns) and words of each conversation of ``turns``, rebuilt.

    ``turns`` has conv_id, turn, role and text. A conversation starts with the first ``keep``
    turns of the conversation ``heads_of`` and goes on with its own turns behind its first
    ``keep``; both are columns of conv_id, ``keep`` at most 3. Turns stand by ``turn``, nulls
    first, ties by a digest of role and text; null role or text counts as empty, and rows
    without conv_id are left out. Other columns are ignored. Texts are reduced to a digest and
    a number of words before anything is shuffled.
    """
    role, text = (F.coalesce(x, F.lit("")) for x in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    conversations = (
        turns.filter("conv_id IS NOT NULL")
        .select("conv_id", F.struct("turn", digest.alias("digest"), words.alias("words")).alias("x"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("x")).alias("turns"))
    )
    heads = conversations.select(F.col("conv_id").alias("head"), F.slice("turns", 1, 3).alias("first"))
    joined = conversations.withColumn("head", heads_of).join(heads, "head", "left")
    none = F.slice("turns", 1, 0)
    both = F.concat(
        F.slice(F.coalesce("first", none), F.lit(1), keep),
        F.slice("turns", keep + 1, F.size("turns")),
    )
    path = F.unhex(F.array_join(F.col("all.digest"), ""))
    return joined.withColumn("all", both).select("conv_id", path.alias("path"), F.col("all.words").alias("words"))


def _hash_ids(chunks: DataFrame) -> DataFrame:
    """name and ends_sha256 of pieces of a comma-joined list (name, conv_id, ids).

    A list is hashed as it streams by, in order; it is never held as a whole.
    """
    schema = pa.schema([("name", pa.binary()), ("ends", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            rows = zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True)
            for own, ids in rows:
                if own != name:
                    if state is not None:
                        done.append((name, state.hexdigest()))
                    name, state = own, hashlib.sha256()
                    state.update(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pydict(
                {"name": [x for x, _ in done], "ends": [x for _, x in done]}, schema=schema
            )
        if state is not None:
            yield pa.RecordBatch.from_pydict({"name": [name], "ends": [state.hexdigest()]}, schema=schema)

    ordered = chunks.select("name", "conv_id", "ids").repartition("name").sortWithinPartitions("name", "conv_id")
    return ordered.mapInArrow(run, "name binary, ends string")


def build_trie(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """All nodes of the trie of ``conversations`` (conv_id, path, words).

    A node is a distinct sequence of first turns; ``path`` holds TURN bytes of digest for each
    turn. Returns conv_id (the smallest member), depth, parent_conv_id (the parent's conv_id),
    n_convs (members), n_children, n_leaves (childless nodes in its subtree), saved_tokens (its
    subtree's sum of (n_convs - 1) * words of the last turn) and ends_sha256 (of the ids of
    conversations that end there, ascending, joined by commas). A conversation without turns
    ends at the root. conv_id must be unique; without conversations there are no nodes.

    A task holds one shard, and at least one conversation. Conversations of equal turns
    spread over shards like all others. Only the hash of a list of ids needs one task to read
    the list, as text in pieces of a shard each.
    """
    ddl = "kind string, shard string, name binary, parent binary, " + ", ".join(
        f"{x} {'string' if x == 'ends_sha256' else 'bigint'}" for x in NODES
    )
    ddl += ", path binary, " + ", ".join(f"{x} array<bigint>" for x in SUMS) + ", ids string"
    records, spines, rounds = conversations, False, []
    while True:
        held = F.sum(F.length("path") / F.lit(TURN) + 1)
        turns, count = records.agg(held, F.count("*")).first()
        if not count:
            break
        whole = turns <= SHARD_TURNS or count <= SHARD_RECORDS
        by = ["path"] if spines else ["path", "conv_id"]
        dealt = records.coalesce(1) if whole else records.repartitionByRange(*by)
        solved = dealt.sortWithinPartitions(*by).mapInArrow(_solve(len(rounds), spines, whole), ddl)
        rounds.append(scratch.write(solved))
        if whole:
            break
        records, spines = rounds[-1].filter("kind = 'spine'").select("path", *SUMS), True
    empty = hashlib.sha256(b"").hexdigest()
    if not rounds:
        return conversations.sparkSession.createDataFrame([], ddl).select(*NODES)
    nodes = rounds[0]
    for more in rounds[1:]:
        nodes = nodes.unionByName(more)
    nodes = nodes.filter("kind = 'node'").select("shard", "name", "parent", *NODES)
    if len(rounds) > 1:
        nodes = _finish(rounds, nodes, scratch)
    return nodes.select(*[x for x in NODES if x != "ends_sha256"], F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def _finish(rounds: list[DataFrame], nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Put in the parents' ids and the hashes of lists that only later rounds know.

    Many nodes may have one parent on a spine, so they are joined by shard and parent.
    """
    later = scratch.write(nodes.filter("name IS NOT NULL"))
    known = later.select("name", F.col("conv_id").alias("known"))
    wanted = nodes.filter("parent IS NOT NULL").select("shard", F.col("parent").alias("name")).distinct()
    parents = scratch.write(
        wanted.join(known, "name").select("shard", F.col("name").alias("parent"), "known")
    )
    ends = scratch.write(_hash_ids(rounds[0].filter("kind = 'ids'")))
    hashed = later.join(ends, "name", "left").withColumn("ends_sha256", F.col("ends")).drop("ends")
    return (
        nodes.filter("name IS NULL")
        .unionByName(hashed)
        .join(parents, ["shard", "parent"], "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "known"))
    )
