from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from touchline.llm.rules import LineLimits, apply_rules, repeated_words


def plain(text):
    """The contract's counts, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


def test_repeated_words():
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        assert repeated_words([w.encode() for w in words]) == plain(" ".join(words))[4]


def test_counts_of_odd_texts(docs, scratch):
    rng = random.Random(3)
    pool = "ab#|é 　\x1c\x85 \t\n\v\f\r"
    texts = [None, "", " \n ", "x" * 50_000, "a\n" * 3000, "a b c d e f g h " * 500]
    texts += ["".join(rng.choices(pool, k=rng.randint(0, 300))) for _ in range(150)]
    rows = [*enumerate(texts), (None, "a b"), (3, texts[3])]
    found = apply_rules(docs(rows).withColumnRenamed("lang", "n_words"), scratch).collect()
    ours = sorted(
        ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
         for r in found), key=str)
    assert ours == sorted(((i, *plain(t)) for i, t in rows), key=str)
    assert not any(r.kept for r in found if r.base_failed)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(n))


def test_frequent_lines_go_and_depleted_documents_with_them(docs, scratch):
    rng = random.Random(4)
    common = "This line  stands Everywhere, No 1"
    rows = []
    for i in range(60):
        rows.append((i, f"{common.replace('1', str(i))}\n{words(rng, 30)}"))
    boiler = [words(rng, 25) for _ in range(3)]
    rows += [(100 + i, "\n".join([*boiler, words(rng, 4 + i % 3)])) for i in range(30)]
    rows += [(200, words(rng, 40))]
    limits = LineLimits(documents=10, share=0.05, left=0.3)
    found = {r.doc_id: r for r in apply_rules(docs(rows), scratch, limits).collect()}
    assert all(found[i].kept and found[i].n_removed_words == 6 for i in range(60))
    assert all(not found[100 + i].kept and found[100 + i].n_removed_words == 75 for i in range(30))
    assert found[200].kept and found[200].n_removed_words == 0


def test_copies_of_one_text_count_once(docs, scratch):
    rng = random.Random(5)
    text = "\n".join(words(rng, 12) for _ in range(4))
    rows = [(i, text) for i in range(200)] + [(i, words(rng, 40)) for i in range(200, 240)]
    found = apply_rules(docs(rows), scratch, LineLimits(5, 0.01, 0.3)).collect()
    assert len(found) == 240 and all(r.kept for r in found)


@pytest.mark.parametrize("source", [None, "", "s"])
def test_hosts_are_counted_apart(spark, docs, scratch, source):
    rng = random.Random(6)
    line = words(rng, 30)
    rows = [(i, f"{line}\n{words(rng, 2)}") for i in range(30)]
    one = docs(rows, source=source)
    other = docs([(1000 + i, t) for i, t in rows[:3]], source="other")
    found = apply_rules(one.union(other), scratch, LineLimits(10, 0.1, 0.3)).collect()
    assert {r.doc_id for r in found if r.kept} == {1000, 1001, 1002}


def test_empty_table(docs, scratch):
    assert apply_rules(docs([]), scratch).count() == 0
