"""Near-duplicates by Order MinHash.

A sketch takes the few smallest hashes of a text's word k-mers, each k-mer
labelled with the number of its occurrence, and keeps them in the order of the
text. So it depends on the order of the words, as the edit distance does. Texts
that agree in a band of sketches are candidates; a banded alignment of their
k-mers decides.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import Rows, Scratch, Work, lists, map_slices
from touchline.llm.components import connected_components

#: Words of a k-mer and the least similarity of near-duplicates.
KMER, SIMILARITY = 5, 0.8
#: k-mers of a sketch, sketches of a band, bands.
KEPT, ROWS, BANDS = 2, 2, 16
#: Texts that share as many of all k-mers with their group's centre, in any order, tell what the
#: group has in common, and are compared within the group.
NEAR = 0.4
#: Texts that one task compares with each other, and smallest hashes of a text's differences,
#: any two of which are a key where a single difference is shared by more texts than that.
TOGETHER, LEAST = 32, 9
#: Rounds of groups within groups, each of which lacks its own centre.
MOST_ROUNDS = 40
#: Numbers of a text's matrix of hashes that are handled at once.
PART = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeds(n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def labelled_kmers(text: str) -> np.ndarray:
    """Hashes of the word k-mers in text order, each with the number of its occurrence.

    Words are lower-cased and parted by white space. A text with fewer words than
    a k-mer is one k-mer; one without words has none. All hashes differ.
    """
    words = text.lower().encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(KMER, len(words))
    n = len(words) - width + 1
    with np.errstate(over="ignore"):
        kmers = np.full(n, np.uint64(width))
        for i in range(width):
            kmers = kmers * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
        kmers = _mixed(kmers)
        order = np.argsort(kmers, kind="stable")
        ranked = kmers[order]
        first = np.r_[True, ranked[1:] != ranked[:-1]]
        start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        number = np.empty(n, np.uint64)
        number[order] = (np.arange(n) - start).astype(np.uint64)
        return _mixed(kmers + number * np.uint64(0xD6E8FEB86659FD93))


def order_sketches(kmers: np.ndarray, sketches: int = ROWS * BANDS) -> np.ndarray:
    """One hash for each sketch: its KEPT smallest k-mers, in text order."""
    seeds, n = _seeds(sketches), len(kmers)
    kept = min(KEPT, n)
    out = np.empty((sketches, kept), np.int64)
    for start in range(0, sketches, max(1, PART // n)):
        rows = slice(start, start + max(1, PART // n))
        ranks = _mixed(kmers[None, :] ^ seeds[rows, None])
        out[rows] = np.argpartition(ranks, kept - 1, axis=1)[:, :kept] if kept < n else np.arange(n)
    chosen = kmers[np.sort(out, axis=1)]
    with np.errstate(over="ignore"):
        value = np.zeros(sketches, np.uint64)
        for i in range(kept):
            value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + chosen[:, i])
    return value


def bands(kmers: np.ndarray) -> list[int]:
    """A hash for each band of sketches; none for a text without words."""
    if not len(kmers):
        return []
    sketches = order_sketches(kmers).reshape(BANDS, ROWS)
    with np.errstate(over="ignore"):
        value = np.arange(BANDS, dtype=np.uint64)
        for i in range(ROWS):
            value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + sketches[:, i])
    return value.view(np.int64).tolist()


def aligned(a: np.ndarray, b: np.ndarray) -> int:
    """k-mers matched by the longest alignment in order, within a band.

    Similar texts leave few k-mers unmatched, so matches lie near the diagonal.
    Labelled k-mers match one place at most: the longest rising sequence of
    places is the best alignment.
    """
    room = math.floor((1 - SIMILARITY) / (1 + SIMILARITY) * (len(a) + len(b)) + 1e-9)
    order = np.argsort(a)
    at = np.minimum(np.searchsorted(a, b, sorter=order), len(a) - 1)
    place = order[at]
    hit = np.flatnonzero((a[place] == b) & (np.abs(place - np.arange(len(b))) <= room))
    rising: list[int] = []
    for x in place[hit].tolist():
        i = bisect_left(rising, x)
        if i == len(rising):
            rising.append(x)
        else:
            rising[i] = x
    return len(rising)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Matched k-mers as a share of all different ones of both texts."""
    if not len(a) or not len(b):
        return 0.0
    n = aligned(a, b)
    return n / (len(a) + len(b) - n)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    return similarity(a, b) >= SIMILARITY - 1e-9


def _sketch() -> Work:
    def work(batch: pa.RecordBatch) -> Rows:
        kmers = [labelled_kmers(x or "") for x in batch.column("text").to_pylist()]
        return {"content": batch.column("content"), "bands": [bands(x) for x in kmers]}

    return work


def _kmers() -> Work:
    def work(batch: pa.RecordBatch) -> Rows:
        kmers = [labelled_kmers(x) for x in batch.column("text").to_pylist()]
        return {"content": batch.column("content"), "kmers": [x.view(np.int64) for x in kmers]}

    return work


def _verify() -> Work:
    def work(batch: pa.RecordBatch) -> Rows:
        members, centres = (
            [x.view(np.uint64) for x in lists(batch.column(name))]
            for name in ("member_kmers", "centre_kmers")
        )
        pairs = list(zip(members, centres, strict=True))
        shares = [similarity(a, b) for a, b in pairs]
        # k-mers that one of the two texts has and the other one lacks.
        added = [np.setdiff1d(a, b, assume_unique=True).view(np.int64) for a, b in pairs]
        missing = [np.setdiff1d(b, a, assume_unique=True).view(np.int64) for a, b in pairs]
        # Whatever their order, unlike the similarity.
        common = [(len(a) - len(x)) / (len(b) + len(x)) for (a, b), x in zip(pairs, added, strict=True)]
        return {
            "member": batch.column("member"),
            "centre": batch.column("centre"),
            "linked": [x >= SIMILARITY - 1e-9 for x in shares],
            "near": [x >= NEAR for x in common],
            "added": added,
            "missing": missing,
            "length": [len(a) for a, _ in pairs],
            "centre_length": [len(b) for _, b in pairs],
        }

    return work


def _sized(members: DataFrame, scratch: Scratch) -> DataFrame:
    """key, content and n (texts of the key) of ``members`` (key, content), where n > 1."""
    # Written first: a join whose sides are both shuffled for it can split a hot key.
    sizes = scratch.write(members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    return scratch.write(members.join(sizes, "key"))


def _centred(grouped: DataFrame, scratch: Scratch) -> DataFrame:
    """member and centre, of the groups (key) of ``grouped`` (key, content, n texts of the key).

    The centre is the member that meets most others over all groups: an original
    meets its variants more often than they meet each other. Every member is
    paired with it alone, so pairs grow with members, not with their square.
    """
    degree = grouped.groupBy("content").agg(F.sum("n").alias("degree"))
    centres = scratch.write(
        grouped.join(degree, "content")
        .groupBy("key")
        .agg(F.max(F.struct("degree", "content")).alias("most"))
        .select("key", F.col("most.content").alias("centre"))
    )
    return (
        grouped.join(centres, "key")
        .filter(F.col("content") != F.col("centre"))
        .select(F.col("content").alias("member"), "centre")
        .distinct()
    )


def _checked(pairs: DataFrame, kmers: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs with linked and near (how similar they are) and what a member adds and lacks."""
    member = kmers.select(F.col("content").alias("member"), F.col("kmers").alias("member_kmers"))
    centre = kmers.select(F.col("content").alias("centre"), F.col("kmers").alias("centre_kmers"))
    # Sorted and merged at any size: both sides grow with the corpus. By centre first, while rows
    # are short: a hot one's k-mers then go out by member, so that texts are dealt evenly.
    joined = pairs.join(centre.hint("merge"), "centre").join(member.hint("merge"), "member")
    shape = {
        "member": "binary", "centre": "binary", "linked": "boolean", "near": "boolean",
        "added": "array<long>", "missing": "array<long>", "length": "long", "centre_length": "long",
    }
    return scratch.write(map_slices(joined, _verify, shape))


def _against_the_group(checked: DataFrame, scratch: Scratch) -> DataFrame:
    """group, content, length, own, lacks, size and also, for groups with a text that doesn't match.

    What a group has in common are the k-mers of its centre, without those that
    most members lack, and with those that most members add. ``own`` are the k-mers
    a text adds to that, ``lacks`` those that it is without, ``size`` weighs both. The
    centre itself is among the texts. ``length`` is the number of a text's k-mers, ``also`` tells
    whether it is similar to the centre.
    """
    # Written first: a join whose sides are both shuffled for it can split a hot centre. The
    # group's size goes along with its rows, so that only k-mers of its majority meet by centre.
    open_ = scratch.write(
        checked.filter("near")
        .groupBy("centre")
        .agg(
            F.count("*").alias("members"),
            F.bool_and("linked").alias("done"),
            F.max("centre_length").alias("of_centre"),
        )
        .filter("NOT done")
        .drop("done")
    )
    rows = checked.filter("near").join(open_.drop("of_centre").hint("merge"), "centre")
    kinds = F.explode(
        F.concat(
            F.transform("added", lambda x: F.struct(x.alias("kmer"), F.lit(True).alias("new"))),
            F.transform("missing", lambda x: F.struct(x.alias("kmer"), F.lit(False).alias("new"))),
        )
    )
    most = (
        rows.select("centre", "members", kinds.alias("x"))
        .groupBy("centre", "members", "x")
        .agg(F.count("*").alias("n"))
        .filter(2 * F.col("n") > F.col("members") + 1)
        .groupBy("centre")
        .agg(
            F.collect_list(F.when(F.col("x.new"), F.col("x.kmer"))).alias("gained"),
            F.collect_list(F.when(~F.col("x.new"), F.col("x.kmer"))).alias("lost"),
        )
    )
    none = F.array().cast("array<bigint>")
    common = scratch.write(
        open_.join(most, "centre", "left").select(
            "centre",
            "of_centre",
            F.coalesce("gained", none).alias("gained"),
            F.coalesce("lost", none).alias("lost"),
        )
    )
    centres = common.select(
        F.col("centre").alias("group"), F.col("centre").alias("content"), F.col("of_centre").alias("length"),
        F.col("lost").alias("own"), F.col("gained").alias("lacks"), F.lit(True).alias("also"),
    )
    # A text has what it adds to the centre and the group doesn't, and what it
    # shares with the centre though the group has lost it.
    own = F.concat(F.array_except("added", "gained"), F.array_except("lost", "missing"))
    lacks = F.concat(F.array_except("missing", "lost"), F.array_except("gained", "added"))
    members = rows.join(common.hint("merge"), "centre").select(
        F.col("centre").alias("group"), F.col("member").alias("content"), "length",
        own.alias("own"), lacks.alias("lacks"), F.col("linked").alias("also"),
    )
    # Two texts without a common difference are similar if what they lack, and SIMILARITY of
    # what they add, is together at most 1 - SIMILARITY of what the group has in common.
    weight = F.size("lacks") + SIMILARITY * F.size("own")
    return members.unionByName(centres).withColumn("size", weight)


def near_links(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) between different texts that are similar, enough to connect them all. Read
    them once: those of small groups are found as they are read.

    ``texts`` has content (digest of the text) and text. Groups are texts that
    agree in a band; every text is compared with its group's centre. Some may be
    similar to other texts of the group, though not to the centre. So wherever a
    text of a group doesn't match:

    1. What the group has in common is found, and all are compared with the text that
       differs least from it.
    2. Two similar texts either share a difference from what is common, a k-mer that both
       add or both lack, or both are similar to that text, as it differs no more than either
       (see ``size``). So where one of them isn't, all texts that share a difference are
       compared, if they are at most TOGETHER. Only a text's rarest differences count, so
       many that a similar text must have one of them (see ``_telling``). Differences that
       more texts share count in pairs: texts that agree in two of the LEAST smallest hashes of their differences form
       groups, and large ones of these are handled like the first, until none is left.
    """
    sketched = scratch.write(
        map_slices(texts, _sketch, {"content": "binary", "bands": "array<long>"}).distinct()
    )
    members = sketched.select("content", F.posexplode("bands").alias("slot", "value")).select(
        F.xxhash64("slot", "value").alias("key"), "content"
    )
    pairs = scratch.write(_centred(_sized(members, scratch), scratch))
    involved = pairs.select(F.explode(F.array("member", "centre")).alias("content")).distinct()
    # Copies of a text are one here; each task brings a text once.
    wanted = texts.join(involved.hint("merge"), "content", "left_semi").groupBy("content").agg(F.first("text").alias("text"))
    kmers = scratch.write(map_slices(wanted, _kmers, {"content": "binary", "kmers": "array<long>"}))
    links = texts.select(F.col("content").alias("a"), F.col("content").alias("b")).limit(0)
    small = None
    if pairs.isEmpty():
        return links
    for number in range(MOST_ROUNDS):
        first = _checked(pairs, kmers, scratch)
        own = scratch.write(_against_the_group(first, scratch))
        if own.isEmpty():
            links = links.union(first.filter("linked").select("member", "centre"))
            return links if small is None else links.union(_small_groups(small, kmers))
        nearest = own.groupBy("group").agg(F.min(F.struct("size", "content", "also")).alias("least"))
        nearest = nearest.select("group", F.col("least.content").alias("second"), F.col("least.also").alias("joined"))
        # ``joined``: is linked to the second by way of the centre, or not at all; needs no comparing.
        seconds = scratch.write(
            own.select("group", "content", "also")
            .join(nearest.hint("merge"), "group")
            .filter("content <> second")
            .select("group", "content", "second", (F.col("also") & F.col("joined")).alias("joined"))
        )
        again = seconds.filter("NOT joined AND second <> `group`")
        again = again.select(F.col("content").alias("member"), F.col("second").alias("centre"))
        second = _checked(again.distinct(), kmers, scratch)
        for checked in (first, second):
            links = links.union(checked.filter("linked").select("member", "centre"))
        told = scratch.write(_differences(own, seconds, second))
        single = told.select(
            "group", "content", "most", F.size("keys").alias("all"), F.explode("keys").alias("key"), "matched"
        )
        telling = scratch.write(_telling(single))
        rare = telling.filter(F.col("n") <= TOGETHER).select("key", "content", "matched")
        # Only texts with a difference that many share need to meet by pairs as well.
        often = telling.filter(F.col("n") > TOGETHER)
        pair = _pair_keys(told, often.select("group", "content").distinct())
        parts = scratch.write(pair)
        found = scratch.write(parts.join(_open_keys(parts, scratch), "key"))
        close = found.filter(F.col("n") <= TOGETHER).select("key", "content", "matched")
        # A group of one round may come again in another one, with other texts.
        groups = rare.union(close).withColumn("key", F.xxhash64(F.lit(number), "key"))
        small = groups if small is None else small.union(groups)
        large = found.filter(F.col("n") > TOGETHER).select("key", "content", "n")
        if large.isEmpty():
            # Those of all rounds at once: many are parts of others.
            return links.union(_small_groups(small, kmers))
        pairs = _centred(large, scratch)
    raise RuntimeError(f"groups still have unmatched texts after {MOST_ROUNDS} rounds")


def _pairs_apart(once: DataFrame) -> DataFrame:
    """place, x and y: the pairs of each row's texts, without those whose texts are both matched."""
    place = F.struct(F.size("texts").alias("n"), "key").alias("place")
    others = F.expr("filter(slice(texts, i + 2, size(texts)), y -> NOT (x.matched AND y.matched))")
    single = once.select(place, F.posexplode("texts").alias("i", "x"), "texts")
    return single.select("place", "x", F.explode(others).alias("y"))


def _compared_once(members: DataFrame) -> DataFrame:
    """key and content: groups of ``members`` (key, content, matched) such that each pair of
    texts that stand together in some group does so in one of these, unless both are matched.

    Texts share many differences, so most groups are parts of others. A pair is left to the
    largest group that has it, and a text to the groups that are left a pair of it.
    """
    texts = F.array_sort(F.collect_list(F.struct("content", "matched")))
    sets = members.groupBy("key").agg(texts.alias("texts"))
    once = sets.groupBy("texts").agg(F.min("key").alias("key"))
    left = (
        _pairs_apart(once)
        .groupBy(F.col("x.content").alias("a"), F.col("y.content").alias("b"))
        .agg(F.max("place").alias("place"))
    )
    return left.select("place.key", F.explode(F.array("a", "b")).alias("content")).distinct()


def _small_groups(members: DataFrame, kmers: DataFrame) -> DataFrame:
    """Links (a, b) among the texts of groups of up to TOGETHER texts. ``members`` has key,
    content and matched: texts of a group that are matched are linked to one text already."""
    joined = _compared_once(members).join(kmers, "content")
    groups = joined.groupBy("key").agg(F.collect_list(F.struct("content", "kmers")).alias("texts"))

    def setup() -> Work:
        def work(batch: pa.RecordBatch) -> Rows:
            links: list[tuple[bytes, bytes]] = []
            for texts in batch.column("texts"):
                group = texts.values
                own = [x.view(np.uint64) for x in lists(group.field("kmers"))]
                rows = list(zip(group.field("content").to_pylist(), own, strict=True))
                links += [(a, b) for (a, x), (b, y) in combinations(rows, 2) if similar(x, y)]
            return {"a": [a for a, _ in links], "b": [b for _, b in links]}

        return work

    return map_slices(groups, setup, {"a": "binary", "b": "binary"})


def _telling(single: DataFrame) -> DataFrame:
    """group, content, key, n (texts) and matched of the differences by which similar texts meet.

    k-mers that only one of two texts has are differences of one of them alone. Similar ones
    have at most (1 - SIMILARITY) / SIMILARITY of the k-mers of either: ``most``. So they share
    one of the rarest ``most + 1`` of each (``all`` are a text's differences), in one order for
    all texts: by n, then by key. Those that no other text has come first.
    """
    sizes = single.groupBy("key").agg(F.bool_and("matched").alias("done"), F.count("*").alias("n")).filter("n > 1")
    shared = F.array_sort(F.collect_list(F.struct("n", "key", "done")))
    return (
        single.join(sizes, "key")
        .groupBy("group", "content", "most", "all", "matched")
        .agg(shared.alias("shared"))
        # Of the rarest ones, as many as the text has alone are taken already.
        .withColumn("left", F.greatest(F.lit(0), F.col("most") + 1 - (F.col("all") - F.size("shared"))))
        .select("group", "content", "matched", F.explode(F.expr("slice(shared, 1, int(left))")).alias("x"))
        .filter("NOT x.done")
        .select("group", "content", "x.key", "x.n", "matched")
    )


def _open_keys(parts: DataFrame, scratch: Scratch) -> DataFrame:
    """key and n (texts) of the groups that have several texts, not all of them matched."""
    groups = parts.groupBy("key").agg(F.bool_and("matched").alias("done"), F.count("*").alias("n"))
    return scratch.write(groups.filter("NOT done AND n > 1").select("key", "n"))


def _differences(own: DataFrame, seconds: DataFrame, second: DataFrame) -> DataFrame:
    """group, content and keys of its differences from what the group has in common; ``matched``
    tells whether links connect it to the text that differs least, directly or by the centre.
    A similar text lacks at most ``most`` of the differences."""
    linked = second.filter("linked").select(
        F.col("member").alias("content"), F.col("centre").alias("second"), F.lit(True).alias("linked")
    )
    tried = seconds.join(linked.hint("merge"), ["content", "second"], "left")
    matched = F.col("joined") | F.coalesce("linked", F.lit(False))

    def keys(side: str) -> Column:
        return F.transform(side, lambda kmer: F.xxhash64("group", F.lit(side), kmer))

    most = F.floor(F.col("length") * ((1 - SIMILARITY) / SIMILARITY) + 1e-6)
    return own.join(tried.select("group", "content", matched.alias("matched")).hint("merge"), ["group", "content"]).select(
        "group", "content", most.alias("most"), F.concat(keys("own"), keys("lacks")).alias("keys"), "matched"
    )


def _pair_keys(told: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, content and matched: two of the smallest hashes of a text's differences are a key."""

    def hashed(seed: int) -> Column:
        return F.array_min(F.transform("keys", lambda x: F.xxhash64(F.lit(seed), x)))

    least = told.join(wanted.hint("merge"), ["group", "content"]).select(
        "group", "content", "matched", F.array(*map(hashed, range(LEAST))).alias("least")
    )
    keys = [
        F.xxhash64("group", F.lit(i), F.lit(j), F.col("least")[i], F.col("least")[j])
        for i, j in combinations(range(LEAST), 2)
    ]
    return least.select(F.explode(F.array(*keys)).alias("key"), "content", "matched")


def near_duplicates(docs: DataFrame, scratch: Scratch, key: str = "doc_id") -> DataFrame:
    """doc_id, class_id, content and kept of every document.

    Documents of a class are connected by equal texts or by similar ones: whole
    texts whose labelled five-word k-mers align in order to SIMILARITY of all.
    class_id is the smallest doc_id of the class; ``kept`` marks one document of
    each class, the one with that id (of several, the one with the smallest
    ``content``, a digest of the text). Texts that are null or without words are
    not compared; each is a class of its own. Rows with equal id and text are one
    document and get the same answer. Null ids come last in a class.
    """
    ids = docs.select(F.col(key).alias("doc_id"), F.unhex(F.md5("text")).alias("content"), "text")
    links = near_links(ids.filter("text IS NOT NULL").select("content", "text"), scratch)
    found = connected_components(links, scratch)
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^ \t\n\x0B\f\r]")
    own = ids.select("doc_id", "content", wordless.alias("wordless"))
    joined = scratch.write(
        own.join(found, own["content"] == found["node"], "left").select(
            "doc_id",
            "content",
            F.when(F.col("wordless"), F.unhex(F.md5(F.concat(F.lit("id "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))))
            .otherwise(F.coalesce("component", "content"))
            .alias("class"),
        )
    )
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")
    keepers = scratch.write(joined.groupBy("class").agg(F.min(place).alias("keeper")))
    keeper = F.col("keeper")
    return joined.join(keepers, "class").select(
        F.col("doc_id").alias(key),
        keeper["doc_id"].alias("class_id"),
        "content",
        (F.col("doc_id").eqNullSafe(keeper["doc_id"]) & F.col("content").eqNullSafe(keeper["content"])).alias("kept"),
    )

