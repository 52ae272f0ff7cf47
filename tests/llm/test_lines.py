from __future__ import annotations

import random

import numpy as np

from touchline.llm import lines as L
from touchline.llm.lines import dedup_lines, minima, windows


def brute(rows, least=L.MIN_WORDS):
    """Lines that lie in a run of enough words which also stands earlier.

    rows: (place, text) with sortable places. Returns place -> set of line numbers.
    """
    seqs = {p: [(i, " ".join(x.split())) for i, x in enumerate((t or "").split("\n")) if x.split()] for p, t in rows}
    seen: dict[tuple, tuple] = {}
    spots = []
    for p, seq in seqs.items():
        for a in range(len(seq)):
            for b in range(a + 1, len(seq) + 1):
                run = tuple(x for _, x in seq[a:b])
                if sum(len(x.split()) for x in run) >= least:
                    spots.append((run, (p, a), [i for i, _ in seq[a:b]]))
                    seen[run] = min(seen.get(run, (p, a)), (p, a))
    gone = {p: set() for p in seqs}
    for run, place, numbers in spots:
        if place > seen[run]:
            gone[place[0]].update(numbers)
    return gone


def expected(rows, least=L.MIN_WORDS):
    gone = brute([((i is not None, i or 0), t) for i, t in rows], least)
    return {
        i: (t and "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[(i is not None, i or 0)]),
            len(gone[(i is not None, i or 0)]))
        for i, t in rows
    }


def ours(frame, scratch):
    return {r.doc_id: (r.text, r.n_removed_lines) for r in dedup_lines(frame, scratch).collect()}


def test_random_documents(docs, scratch, monkeypatch):
    """Short runs over few lines, so that repeats overlap in all ways."""
    rng = random.Random(7)
    monkeypatch.setattr(L, "MIN_WORDS", 6)
    monkeypatch.setattr(L.windows, "__defaults__", (6,))
    kinds = [" ".join(rng.choice("abcd") for _ in range(n)) for n in (1, 1, 2, 2, 3, 4, 7)] + ["", "  "]
    rows = [(i, "\n".join(rng.choices(kinds, k=rng.randint(0, 12)))) for i in range(60)]
    assert ours(docs(rows), scratch) == expected(rows, 6)


def passage(rng, n):
    return "\n".join(" ".join(f"p{rng.randrange(10**9)}" for _ in range(13)) for _ in range(n))


def test_passages_of_over_fifty_words(docs, scratch):
    rng = random.Random(8)
    shared, one_line = passage(rng, 5), " ".join(f"q{i}" for i in range(60))
    rows = [(1, passage(rng, 3) + "\n" + shared), (2, passage(rng, 2)),
            (3, shared + "\n" + passage(rng, 2)), (4, one_line), (5, "Intro here.\n" + one_line),
            (6, None), (7, ""), (8, shared), (9, "\n".join(shared.split("\n")[:3])),
            (None, passage(rng, 6))]
    found = ours(docs(rows), scratch)
    assert found == expected(rows)
    assert found[3][1] == 5 and found[5] == ("Intro here.", 1) and found[8] == ("", 5)
    assert found[1][1] == found[2][1] == found[9][1] == 0


def test_a_hot_passage_and_a_line_repeated_within_a_text(docs, scratch):
    rng = random.Random(9)
    shared = passage(rng, 4)
    rows = [(i, f"{shared}\nown line {i}") for i in range(300)] + [(999, "same two words here\n" * 40)]
    found = ours(docs(rows), scratch)
    assert found[0] == (rows[0][1], 0)
    assert all(found[i] == (f"own line {i}", 4) for i in range(1, 300))
    assert found[999][1] == 39


def test_columns_and_equal_rows(spark, docs, scratch):
    rng = random.Random(10)
    text = passage(rng, 5)
    frame = docs([(1, text), (1, text), (2, text), (None, passage(rng, 5))])
    frame = frame.selectExpr("*", "1 AS id", "'x' AS content", "array(1) AS runs", "'y' AS n_removed_lines",
                             "'z' AS hashes", "map('a', 1) AS marks")
    out = dedup_lines(frame, scratch)
    assert set(out.columns) == set(frame.columns)
    rows = out.collect()
    assert sorted((r.doc_id or 0, r.n_removed_lines, r.n_chars) for r in rows) == [
        (0, 0, len(rows[0].text) if rows[0].doc_id is None else next(len(r.text) for r in rows if r.doc_id is None)),
        (1, 0, len(text)), (1, 0, len(text)), (2, 5, 0),
    ]
    assert {(r.id, r.content, r.hashes) for r in rows} == {(1, "x", "z")}
    assert dedup_lines(frame.limit(0), scratch).count() == 0


def test_a_very_long_text(docs, scratch):
    rng = random.Random(11)
    long = "\n".join(f"line {rng.randrange(10**9)} of it" for _ in range(30_000))
    found = ours(docs([(1, long), (2, "start\n" + long)]), scratch)
    assert found[1] == (long, 0) and found[2] == ("start", 30_000)


def test_windows_and_minima_against_the_definition():
    rng = np.random.default_rng(12)
    for _ in range(100):
        words = rng.integers(1, 6, rng.integers(0, 20))
        hashes = rng.integers(0, 8, len(words))
        first, last = windows(words, 7)
        found = set(zip(first.tolist(), last.tolist(), strict=True))
        wanted = set()
        for i in range(len(words)):
            ends = [j for j in range(i, len(words)) if words[i : j + 1].sum() >= 7]
            starts = [a for a in range(i + 1) if words[a : i + 1].sum() >= 7]
            wanted |= {(i, ends[0])} if ends else set()
            wanted |= {(starts[-1], i)} if starts else set()
        assert found == wanted
        for a, b, m in zip(first, last, minima(hashes, first, last), strict=True):
            assert m == max(i for i in range(a, b + 1) if hashes[i] == hashes[a : b + 1].min())


def brute_words(rows, least):
    """Kept words of each row: a word goes with every window that also stands earlier."""
    seqs = {i: (t or "").split() for i, t in rows}
    order = sorted(seqs, key=lambda i: (i is not None, i or 0))
    seen, kept = set(), {}
    for i in order:
        gone = set()
        for a in range(len(seqs[i]) - least + 1):
            window = tuple(seqs[i][a : a + least])
            if window in seen:
                gone.update(range(a, a + least))
            seen.add(window)
        kept[i] = [w for n, w in enumerate(seqs[i]) if n not in gone]
    return kept


def test_words_within_lines_against_all_windows(docs, scratch, monkeypatch):
    rng = random.Random(13)
    for least in (5, 6):
        monkeypatch.setattr(L, "MIN_WORDS", least)
        monkeypatch.setattr(L.without_words, "__defaults__", (least,))
        parts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (1, 2, 3, 5, 8, 13)] + ["\n", " \n\t"]
        rows = [(i, " ".join(rng.choices(parts, k=rng.randint(0, 9)))) for i in [None, *range(60)]]
        rows += [(99, rows[7][1]), (100, rows[7][1])]
        found = dedup_lines(docs(rows), scratch, within=True).collect()
        assert {r.doc_id: r.text.split() for r in found} == brute_words(rows, least)
        given = dict(rows)
        assert all((r.n_removed_lines > 0) == (r.text != given[r.doc_id]) for r in found)
        assert all(r.n_chars == len(r.text) for r in found)


def test_passages_that_start_and_end_within_a_line(docs, scratch):
    rng = random.Random(14)
    words = passage(rng, 6).split()[:70]
    first = " ".join(words[:30]) + "\n" + " ".join(words[30:])
    # Other line breaks, with words of its own before and after it in the same lines.
    second = "Own  start " + " ".join(words[:41]) + "\n\n" + " ".join(words[41:]) + "\town end \nlast"
    middle = f" a {' '.join(words)} b\tc "
    rows = [(1, "Before. " + first + " after"), (2, second), (3, middle), (4, " ".join(words[:49])), (5, None)]
    assert dedup_lines(docs(rows), scratch).filter("n_removed_lines > 0").count() == 0
    found = {r.doc_id: (r.text, r.n_removed_lines) for r in dedup_lines(docs(rows), scratch, within=True).collect()}
    assert found == {1: (rows[0][1], 0), 2: ("Own  start\n\nown end \nlast", 2), 3: (" a b\tc ", 1),
                     4: (rows[3][1], 0), 5: (None, 0)}


def test_the_query_takes_out_words_within_lines(spark, docs, tmp_path):
    from touchline.llm.queries import QUERIES

    shared = passage(random.Random(15), 5).replace("\n", " ")
    docs([(1, f"one {shared} two"), (2, f"three {shared} four")]).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.text for r in QUERIES["op2_line_dedup"](spark, str(tmp_path)).collect()}
    assert found == {1: f"one {shared} two", 2: "three four"}


def test_powers_of_a_base_are_computed_once():
    base = int(L._BASES[0])
    short, long = L._powers(base, 5), L._powers(base, L.KEPT_POWERS + 1)
    assert np.shares_memory(short, L._powers(base, 1000))
    assert [int(x) for x in short] == [pow(base, i, 1 << 64) for i in range(5)]
    assert int(long[-1]) == pow(base, L.KEPT_POWERS, 1 << 64) and (long[:5] == short).all()
    assert len(L._powers(base, 0)) == 0
    # A window has the same hash wherever it stands, in texts beyond the kept powers too.
    piece = np.arange(1, 8, dtype=np.int64) * 12345
    hashes = np.concatenate([piece, np.zeros(L.KEPT_POWERS, np.int64), piece])
    first = np.array([0, len(hashes) - 7])
    assert len(set(L.window_hash(hashes, first, first + 6, base).tolist())) == 1
    assert L.window_hash(piece, first[:1], first[:1] + 6, base) == L.window_hash(hashes, first, first + 6, base)[0]
