from __future__ import annotations

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest

from touchline.llm import neardup as N
from touchline.llm.components import connected_components
from touchline.llm.neardup import aligned, bands, labelled_kmers, near_duplicates, similar


def plain_kmers(text):
    words = text.lower().split()
    grams = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    seen: dict[tuple, int] = {}
    out = []
    for g in grams:
        seen[g] = seen.get(g, -1) + 1
        out.append((g, seen[g]))
    return out


def longest(a, b):
    """Longest common subsequence, by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def plain_similar(a, b):
    x, y = plain_kmers(a), plain_kmers(b)
    n = longest(x, y)
    return bool(x and y) and n >= 0.8 * (len(x) + len(y) - n) - 1e-9


def word(rng):
    return "".join(rng.choices("abcdefghij", k=6))


def text_of(rng, n):
    return " ".join(word(rng) for _ in range(n))


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        i = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[i] = word(rng)
        elif kind == 1:
            words.insert(i, word(rng))
        elif len(words) > 6:
            del words[i]
    return " ".join(words)


def test_kmers_against_the_definition():
    rng = random.Random(1)
    texts = ["", " \n", "one", "One one ONE one one one one one one", "a b c d e f", text_of(rng, 60)]
    codes: dict = {}
    for t in texts:
        kmers, wanted = labelled_kmers(t).tolist(), plain_kmers(t)
        assert len(kmers) == len(wanted) == len(set(kmers))
        for k, w in zip(kmers, wanted, strict=True):
            assert codes.setdefault(k, w) == w


def test_alignment_against_the_plain_table():
    rng = random.Random(2)
    both = [0, 0]
    for _ in range(150):
        a = text_of(rng, rng.randint(1, 80)) if rng.random() < 0.7 else "x y " * rng.randint(1, 30)
        b = edited(rng, a, rng.randint(0, 6))
        if rng.random() < 0.2:
            words = b.split()
            cut = rng.randrange(len(words))
            b = " ".join(words[cut:] + words[:cut])
        assert similar(labelled_kmers(a), labelled_kmers(b)) == plain_similar(a, b)
        both[plain_similar(a, b)] += 1
    assert min(both) > 20


def test_the_band_keeps_matches_of_similar_texts():
    a = np.arange(100, dtype=np.uint64)
    assert aligned(a, a) == 100
    assert aligned(a, np.r_[a[50:], a[:50]]) == 0
    assert aligned(a, np.r_[np.arange(1000, 1010, dtype=np.uint64), a]) == 100


def test_order_matters():
    rng = random.Random(3)
    t = text_of(rng, 400)
    half = t.split()
    turned = " ".join(half[200:] + half[:200])
    same = sum(x == y for x, y in zip(bands(labelled_kmers(t)), bands(labelled_kmers(turned)), strict=True))
    near = sum(
        x == y for x, y in zip(bands(labelled_kmers(t)), bands(labelled_kmers(edited(rng, t, 2))), strict=True)
    )
    assert same <= 6 < near


def brute(rows):
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    kmers = {i: labelled_kmers(t or "") for i, t in rows}
    for (a, x), (b, y) in combinations(rows, 2):
        if x and x.split() and (x == y or (y and similar(kmers[a], kmers[b]))):
            ra, rb = sorted((root(a), root(b)))
            parent[rb] = ra
    return {i: root(i) for i, _ in rows}


def classes(frame, scratch):
    rows = near_duplicates(frame, scratch).collect()
    return {r.doc_id: r.class_id for r in rows}, {r.doc_id for r in rows if r.kept}


def corpus(rng):
    """Families around a text, chains of edits, truncations, exact copies, a shared passage."""
    texts = []
    for n in (8, 20, 60, 150):
        base = text_of(rng, n)
        texts += [base, base, base.upper()] + [edited(rng, base, max(1, n // 60)) for _ in range(6)]
        chain = base
        for _ in range(5):
            chain = edited(rng, chain, max(1, n // 50))
            texts.append(chain)
        texts += [" ".join(base.split()[: int(n * share)]) for share in (0.95, 0.85, 0.7, 0.5)]
    passage = text_of(rng, 70)
    texts += [f"{passage} {text_of(rng, 20)}" for _ in range(50)]
    texts += [text_of(rng, rng.randint(1, 90)) for _ in range(60)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("together", [32, 2])
def test_classes_against_all_pairs(docs, scratch, monkeypatch, together):
    monkeypatch.setattr(N, "TOGETHER", together)
    rows = corpus(random.Random(4))
    found, kept = classes(docs(rows), scratch)
    wanted = brute(rows)
    assert found == wanted
    assert kept == set(wanted.values())


def test_a_family_that_matches_no_one_centre(docs, scratch):
    """Each copy is similar to the original, few to each other; the original is one of many."""
    rng = random.Random(5)
    base = text_of(rng, 200)
    rows = [(i, edited(rng, base, 3)) for i in range(150)] + [(500, base)]
    rows += [(600 + i, edited(rng, base, 9)) for i in range(40)]
    rng.shuffle(rows)
    found, _ = classes(docs(rows), scratch)
    assert found == brute(rows)


def rewritten(rng, text, at):
    """One word replaced, at a share of the text."""
    words = text.split()
    words[int(at * (len(words) - 1))] = f"new{rng.random()}"
    return " ".join(words)


def hidden_family(rng, first):
    """An original, copies with one edit each, and texts that match a copy, not the original."""
    base = text_of(rng, 200)
    words = base.split()
    texts = [base, *[rewritten(rng, base, rng.random()) for _ in range(9)]]
    texts += [" ".join(words[: int(200 * share)]) for share in (0.8, 0.65)]
    return [(first + i, t) for i, t in enumerate(texts)]


def mixed_family(rng, first):
    """Openings, middles and endings of one text, some with a passage put in or taken out."""
    words = text_of(rng, 200).split()
    texts = [" ".join(words)]
    for _ in range(12):
        part = words[rng.randrange(30) : 200 - rng.randrange(45)]
        for _ in range(rng.randrange(3)):
            at, n = rng.randrange(len(part) - 20), rng.randrange(1, 16)
            part = part[:at] + ([f"put{x}" for x in range(n)] if rng.random() < 0.5 else []) + part[at + n :]
        texts.append(" ".join(part))
    return [(first + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("family", [hidden_family, mixed_family])
def test_links_of_texts_that_match_no_centre_are_found(docs, scratch, family):
    """All links that the bands' groups hold are found, also where the centre fits neither text."""
    rng = random.Random(11)
    families = [family(rng, 100 * i) for i in range(60)]
    found, _ = classes(docs([row for rows in families for row in rows]), scratch)
    wanted = {i: c for rows in families for i, c in brute(rows).items()}
    assert found == wanted


def test_rows(docs, scratch):
    long = "word " * 30_000
    rows = [(1, None), (2, None), (3, ""), (4, " \n"), (5, "Hi"), (6, "hi"), (7, "hi there"), (7, "hi there"),
            (None, "hi"), (8, long), (9, long + "end")]
    frame = docs(rows).selectExpr("doc_id", "text", "lang AS class_id", "source AS content", "1 AS kept")
    out = near_duplicates(frame, scratch).collect()
    found = sorted(((r.doc_id, r.class_id, r.kept) for r in out), key=str)
    assert found == sorted([(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True),
                            (6, 5, False), (7, 7, True), (7, 7, True), (None, 5, False),
                            (8, 8, True), (9, 8, False)], key=str)
    assert near_duplicates(frame.limit(0), scratch).count() == 0


def test_components(spark, scratch):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 200 + i) for i in range(300)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(80)]
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    out = connected_components(spark.createDataFrame(links, "a long, b long"), scratch)
    assert {r.node: r.component for r in out.collect()} == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0


def test_groups_that_are_parts_of_others_bring_no_text_again(spark, scratch):
    rng = random.Random(8)
    groups = [rng.sample(range(30), rng.randint(2, 6)) for _ in range(40)]
    groups += [x[:k] for x in groups[:20] for k in range(1, len(x) + 1)]
    matched = [[rng.random() < 0.4 for _ in x] for x in groups]
    rows = [(k, bytes([c]), m) for k, x in enumerate(groups) for c, m in zip(x, matched[k], strict=True)]
    left = N._compared_once(spark.createDataFrame(rows, "key long, content binary, matched boolean")).collect()
    held = {}
    for r in left:
        held.setdefault(r.key, set()).add(r.content[0])
    together = {p for x in held.values() for p in combinations(sorted(x), 2)}
    wanted = {
        tuple(sorted((a, b)))
        for x, flags in zip(groups, matched, strict=True)
        for (a, m), (b, n) in combinations(zip(x, flags, strict=True), 2)
        if not (m and n)
    }
    assert wanted <= together
    assert all(x <= set(groups[k]) for k, x in held.items())
    # One large group and all its parts: each text once.
    big = list(range(12))
    parts = [(0, bytes([c]), False) for c in big]
    parts += [(1 + k, bytes([c]), False) for k in range(50) for c in rng.sample(big, 5)]
    once = N._compared_once(spark.createDataFrame(parts, "key long, content binary, matched boolean"))
    assert sorted((r.key, r.content[0]) for r in once.collect()) == [(0, c) for c in big]


def test_texts_meet_by_their_rarest_differences_only(spark):
    """Similar sets meet, as all their pairs do; those that share what many have don't."""
    rng = random.Random(9)
    rows, sets = [], {}
    for f in range(8):
        base = [f"{f}-{x}" for x in range(30)]
        for i in range(6):
            own = [x for x in base if rng.random() < 0.9] + [f"{f}-{i}-{x}" for x in range(rng.randrange(4))]
            sets[bytes([f, i])] = set(own) | {f"often{x}" for x in range(20)}
    # Texts with much of their own and a passage that all have.
    for i in range(40):
        sets[bytes([99, i])] = {f"alone{i}-{x}" for x in range(60)} | {f"often{x}" for x in range(20)}
    code = {x: k for k, x in enumerate(sorted({x for s in sets.values() for x in s}))}
    most = 12
    for content, own in sets.items():
        rows += [(b"g", content, most, len(own), code[x], False) for x in own]
    frame = spark.createDataFrame(rows, "group binary, content binary, most long, all int, key long, matched boolean")
    told = N._telling(frame).collect()
    held = {}
    for r in told:
        held.setdefault(r.key, set()).add(bytes(r.content))
    together = {p for x in held.values() for p in combinations(sorted(x), 2)}
    near = {
        (a, b)
        for a, b in combinations(sorted(sets), 2)
        if len(sets[a] - sets[b]) <= most and len(sets[b] - sets[a]) <= most
    }
    assert len(near) > 60 and near <= together
    assert not any(r.content[0] == 99 for r in told)
    sizes = {k: sum(code_of == k for s in sets.values() for code_of in map(code.get, s)) for k in held}
    assert all(r.n == sizes[r.key] for r in told)


def test_unlike_texts_with_a_common_passage_are_not_all_compared(docs, scratch, monkeypatch):
    """Texts that are near by a passage that all have, and else unlike, form no small groups."""
    rng = random.Random(10)
    passage = text_of(rng, 120)
    rows = [(i, f"{passage} {text_of(rng, 60)}") for i in range(120)]
    rows += [(200 + i, f"{edited(rng, rows[0][1], 1)}") for i in range(8)]
    compared = []
    plain = N._compared_once
    monkeypatch.setattr(N, "_compared_once", lambda m: compared.append(plain(m)) or compared[-1])
    found, _ = classes(docs(rows), scratch)
    assert found == brute(rows)
    assert {r.content for c in compared for r in c.collect()}.isdisjoint(
        {hashlib.md5(t.encode()).digest() for i, t in rows if 0 < i < 200}
    )


def test_pairs_of_matched_texts_are_not_made(spark):
    rows = [(7, [(bytes([i]), i % 4 > 0) for i in range(32)]), (8, [(bytes([i]), True) for i in range(32)])]
    once = spark.createDataFrame(rows, "key long, texts array<struct<content: binary, matched: boolean>>")
    made = [(r.place.key, bytes(r.x.content), bytes(r.y.content)) for r in N._pairs_apart(once).collect()]
    assert sorted(made) == [
        (7, bytes([a]), bytes([b])) for a, b in combinations(range(32), 2) if a % 4 == 0 or b % 4 == 0
    ]


def test_small_groups_of_all_rounds_are_compared_at_once(docs, scratch, monkeypatch):
    monkeypatch.setattr(N, "TOGETHER", 2)
    rounds, compared = [], []
    telling, once = N._telling, N._compared_once
    monkeypatch.setattr(N, "_telling", lambda x: rounds.append(x) or telling(x))
    monkeypatch.setattr(N, "_compared_once", lambda x: compared.append(x) or once(x))
    rows = corpus(random.Random(4))
    found, _ = classes(docs(rows), scratch)
    assert found == brute(rows)
    assert len(rounds) > 1 and len(compared) == 1


def test_texts_that_their_centre_links_are_not_compared_again(docs, scratch, monkeypatch):
    checks = []
    plain = N._checked
    monkeypatch.setattr(N, "_checked", lambda *given: checks.append(plain(*given)) or checks[-1])
    rng = random.Random(12)
    rows = [row for i in range(30) for row in hidden_family(rng, 100 * i)]
    found, _ = classes(docs(rows), scratch)
    assert found == {i: c for k in range(30) for i, c in brute(rows[12 * k : 12 * k + 12]).items()}
    first, second = ([(bytes(r.member), bytes(r.centre), r.linked) for r in x.collect()] for x in checks[:2])
    by_centre = {}
    for member, centre, linked in first:
        if linked:
            by_centre.setdefault(centre, {centre}).add(member)
    again = {frozenset(x[:2]) for x in second}
    assert again
    for centre, texts in by_centre.items():
        # Pairs of a centre itself with other texts may stand in groups of other centres.
        assert not any(x <= texts - {centre} for x in again)
