"""Byte-level BPE: batched numpy merge rounds over the distinct words of a slice."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from touchline.llm.batches import Rows, Work, map_slices

# Fixed: how the vocabulary's tokenizer cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Encoded words that a task remembers; beyond it, it starts afresh.
CACHE_WORDS = 200_000
SCHEMA = {"n_tokens": "long", "ids": "binary", "decoded": "string"}


@dataclass(frozen=True)
class Vocabulary:
    """Tables of a vocabulary; their size is that of its file.

    byte_ids: id of each single byte. pair_keys: sorted ``left * size + right`` of
    all merges; pair_ranks and pair_ids: their order and result. token_bytes and
    token_ends: the bytes of all tokens, one after the other. special: ids of the
    strings that are taken out of a text before it is cut into words.
    """

    byte_ids: np.ndarray
    size: int
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    pair_ids: np.ndarray
    token_bytes: np.ndarray
    token_ends: np.ndarray
    special: dict[str, int]


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins of bytes: visible Latin-1 itself, others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE vocabulary from a tokenizers JSON file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    ids, to_byte = content["model"]["vocab"], byte_of_char()
    special = {x["content"]: x["id"] for x in content.get("added_tokens", [])}
    size = 1 + max([*ids.values(), *special.values()])
    texts = [b""] * size
    for token, i in ids.items():
        texts[i] = bytes(to_byte[c] for c in token)
    for token, i in special.items():
        texts[i] = token.encode()
    pairs = [x.split(" ") if isinstance(x, str) else x for x in content["model"]["merges"]]
    keys = np.array([ids[a] * size + ids[b] for a, b in pairs], np.int64)
    order = np.argsort(keys, kind="stable")
    return Vocabulary(
        byte_ids=np.array([ids[c] for c, _ in sorted(to_byte.items(), key=lambda x: x[1])]),
        size=size,
        pair_keys=keys[order],
        pair_ranks=order.astype(np.int64),
        pair_ids=np.array([ids[a + b] for a, b in pairs], np.int64)[order],
        token_bytes=np.frombuffer(b"".join(texts), np.uint8),
        token_ends=np.cumsum([len(x) for x in texts]),
        special=special,
    )


def merge_rounds(v: Vocabulary, words: list[bytes]) -> list[bytes]:
    """Ids of each word (one byte or more) as little-endian 32-bit integers.

    All words lie in one flat array. Each round looks up every adjacent pair by
    binary search and merges, in each word, all places of its lowest-ranked pair
    from left to right. Words without a pair leave the array.
    """
    out: list[bytes] = [b""] * len(words)
    symbols = v.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    never = np.iinfo(np.int64).max
    while symbols.size:
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        rank, merged = np.full(symbols.size, never), np.zeros(symbols.size, np.int64)
        if symbols.size > 1 and v.pair_keys.size:
            keys = symbols[:-1] * v.size + symbols[1:]
            at = np.minimum(np.searchsorted(v.pair_keys, keys), v.pair_keys.size - 1)
            hit = np.flatnonzero((v.pair_keys[at] == keys) & (owner[1:] == owner[:-1]))
            rank[hit], merged[hit] = v.pair_ranks[at[hit]], v.pair_ids[at[hit]]
        lowest = np.minimum.reduceat(rank, starts)
        lengths = np.diff(np.r_[starts, symbols.size])
        ended = lowest == never
        if ended.any():
            flat = symbols.astype("<u4").tobytes()
            for s, n in zip(starts[ended].tolist(), lengths[ended].tolist(), strict=True):
                out[owner[s]] = flat[4 * s : 4 * (s + n)]
        lowest = np.repeat(lowest, lengths)
        chosen = np.flatnonzero((rank == lowest) & (lowest != never))
        if chosen.size:
            # In a row of overlapping places every other one is merged.
            first = np.r_[True, np.diff(chosen) != 1]
            run = np.maximum.accumulate(np.where(first, np.arange(chosen.size), 0))
            chosen = chosen[(np.arange(chosen.size) - run) % 2 == 0]
        symbols = symbols.copy()
        symbols[chosen] = merged[chosen]
        keep = lowest != never
        keep[chosen + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    return out


def decode(v: Vocabulary, ids: np.ndarray) -> str:
    """The text of the ids; bytes that are no UTF-8 become replacement characters."""
    if not ids.size:
        return ""
    ends = v.token_ends[ids]
    starts = np.where(ids > 0, v.token_ends[ids - 1], 0)
    lengths = ends - starts
    at = np.cumsum(lengths)
    places = np.arange(at[-1]) + np.repeat(starts - (at - lengths), lengths)
    return v.token_bytes[places].tobytes().decode("utf-8", "replace")


class Encoder:
    """Encodes texts with one vocabulary and remembers the words it has met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self._v = vocabulary
        self._cut = regex.compile(WORDS)
        strings = sorted(vocabulary.special, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, strings))) if strings else None
        self._known: dict[str, bytes] = {}

    def _pieces(self, text: str) -> Iterable[tuple[str, bytes]]:
        """The stretches between special strings, each with the id that follows it."""
        start = 0
        for m in self._special.finditer(text) if self._special else ():
            yield text[start : m.start()], int(self._v.special[m[0]]).to_bytes(4, "little")
            start = m.end()
        yield text[start:], b""

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [[(self._cut.findall(x), end) for x, end in self._pieces(t)] for t in texts]
        if len(self._known) > CACHE_WORDS:
            self._known.clear()
        met = {w for text in cut for words, _ in text for w in words}
        new = [w for w in met if w not in self._known]
        self._known.update(zip(new, merge_rounds(self._v, [w.encode() for w in new]), strict=True))
        known = self._known.__getitem__
        return [b"".join(b"".join(map(known, words)) + end for words, end in t) for t in cut]


def _setup(vocabulary: Callable[[], Vocabulary], kept: tuple[str, ...]) -> Work:
    v = vocabulary()
    encoder = Encoder(v)

    def work(batch: pa.RecordBatch) -> Rows:
        texts = [x or "" for x in batch.column("text").to_pylist()]
        ids = encoder.encode(texts)
        return {name: batch.column(name) for name in kept} | {
            "n_tokens": [len(x) // 4 for x in ids],
            "ids": ids,
            "decoded": [decode(v, np.frombuffer(x, "<u4").astype(np.int64)) for x in ids],
        }

    return work


def encode_and_decode(docs: DataFrame, path: str, kept: dict[str, str]) -> DataFrame:
    """Token ids of every whole text, and the text decoded from them.

    Needs ``text`` and the columns in ``kept`` (name and type), which are carried
    along; others are ignored. Returns ``kept``, n_tokens, ids (little-endian
    32-bit integers, one after the other) and decoded. A null text counts as
    empty: no ids, empty decoded text. Each row is encoded by itself, so repeated
    rows give repeated results and an empty table gives none.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(vars(load_vocabulary(path)))
    names = tuple(kept)
    return map_slices(
        docs.select(*names, "text"),
        lambda: _setup(lambda: Vocabulary(**vocabulary.value), names),
        kept | SCHEMA,
    )
