"""Byte-level BPE with an index of pair occurrences.

The distinct words of a batch that were not met before are encoded together. An index maps every pair of neighbouring
symbols to all its positions. The ranks that occur are applied in ascending order: each position of the pair becomes
one symbol, and the pairs this makes are added to the index. A merge never makes a pair of a lower rank, which is
checked when the vocabulary is read, so one pass over the ranks gives what merging word by word gives.

Null and empty texts have no tokens and decode to an empty text. The strings of special tokens are cut out of a text
and become those tokens, as the tokenizers library does. Repeated rows and rows with a null id are rows like others;
no other column is read, and texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .arrow import with_columns_of_texts

# Distinct words whose tokens a process remembers; beyond it, it starts anew.
REMEMBERED = 500_000


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: itself if it can be seen, else one above 255."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Vocabulary:
    """What a vocabulary file says, ready for encoding. It is sent to the tasks as its text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.text = file.read()

    def __getstate__(self):
        return self.text

    def __setstate__(self, text):
        self.text = text

    @cached_property
    def parsed(self) -> dict:
        parsed = json.loads(self.text)
        model, cut = parsed["model"], parsed["pre_tokenizer"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        if odd or model.get("ignore_merges") or parsed["normalizer"] or cut["type"] != "ByteLevel":
            raise ValueError("this is not a plain byte-level BPE vocabulary")
        if cut["add_prefix_space"] or not cut["use_regex"]:
            raise ValueError("the vocabulary cuts texts in another way")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in parsed["added_tokens"]):
            raise ValueError("the vocabulary has special tokens with conditions")
        return parsed

    @cached_property
    def bytes_of(self) -> dict[int, bytes]:
        """The bytes of every token."""
        stands_for = byte_characters()
        table = {i: bytes(stands_for[c] for c in t) for t, i in self.parsed["model"]["vocab"].items()
                 if all(c in stands_for for c in t)}
        return table | {t["id"]: t["content"].encode() for t in self.parsed["added_tokens"]}

    @cached_property
    def first_symbols(self) -> np.ndarray:
        """The token of every byte."""
        ids = self.parsed["model"]["vocab"]
        return np.array([ids[c] for c, _ in sorted(byte_characters().items(), key=lambda x: x[1])], dtype=np.int64)

    @cached_property
    def pair_table(self) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Pairs as sorted numbers, their ranks, and by rank the pair and what it becomes."""
        ids = self.parsed["model"]["vocab"]
        merges = [p if isinstance(p, list) else p.split(" ") for p in self.parsed["model"]["merges"]]
        pairs = [(ids[left], ids[right], ids[left + right]) for left, right in merges]
        made: dict[int, int] = {}
        for rank, (_, _, token) in enumerate(pairs):
            made.setdefault(token, rank)
        if any(made.get(part, -1) >= rank for rank, pair in enumerate(pairs) for part in pair[:2]):
            raise ValueError("a merge makes a pair of a lower rank")
        keys = np.array([(left << 32) + right for left, right, _ in pairs], dtype=np.int64)
        keys, ranks = np.unique(keys, return_index=True)
        return keys, ranks, pairs

    @cached_property
    def special(self) -> regex.Pattern | None:
        contents = sorted((t["content"] for t in self.parsed["added_tokens"]), key=len, reverse=True)
        return regex.compile("(" + "|".join(map(regex.escape, contents)) + ")") if contents else None

    @cached_property
    def special_ids(self) -> dict[str, bytes]:
        return {t["content"]: t["id"].to_bytes(4, "little") for t in self.parsed["added_tokens"]}

    @cached_property
    def words(self) -> regex.Pattern:
        # Fixed value: the pattern by which byte-level BPE of this kind cuts a text into words.
        return regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )

    @cached_property
    def sure(self) -> set[str]:
        """Characters met so far that every version of Unicode in use assigns alike."""
        return set()

    def is_sure(self, text: str) -> bool:
        """Whether libraries with different versions of Unicode agree on all characters of the text."""
        if text.isascii():
            return True
        new = set(text) - self.sure
        unsure = {c for c in new if unicodedata.category(c) == "Cn"}
        self.sure.update(new - unsure)
        return not unsure

    @cached_property
    def encoder(self) -> Encoder:
        """The encoder of this process, which goes from task to task with the words it remembers."""
        return Encoder(self)

    @cached_property
    def cutter(self):
        return Tokenizer.from_str(self.text).pre_tokenizer

    def cut(self, text: str) -> list[str]:
        """The words of a text. One with characters that only some versions know is cut by the library itself."""
        if not self.is_sure(text):
            return [text[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(text)]
        return self.words.findall(text)


def encode_words(words: list[str], vocabulary: Vocabulary) -> list[bytes]:
    """Tokens of every word as little-endian 32-bit integers."""
    keys, ranks, pairs = vocabulary.pair_table
    spelled = [word.encode() for word in words]
    ends = np.cumsum([len(w) for w in spelled], dtype=np.int64)
    n = int(ends[-1]) if len(ends) else 0
    # A place behind the last one stands for the end of every word; its symbol makes no pair.
    symbols = np.empty(n + 1, dtype=np.int64)
    symbols[:n] = vocabulary.first_symbols[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
    symbols[n] = -1
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    after[n] = n
    after[ends[ends > 0] - 1] = n
    before[np.concatenate([[0], ends])] = n

    index: dict[int, list[np.ndarray]] = {}  # rank -> all positions at which its pair may stand
    waiting: list[int] = []

    def add(at: np.ndarray) -> None:
        """Index the pairs that begin at these positions."""
        pair = (symbols[at] << 32) + symbols[after[at]]
        place = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        known = np.flatnonzero(keys[place] == pair)
        rank = ranks[place[known]]
        order = np.argsort(rank, kind="stable")
        at, rank = at[known][order], rank[order]
        cuts = np.flatnonzero(np.diff(rank, prepend=-1)).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(rank)]):
            r = int(rank[a])
            if r not in index:
                index[r] = []
                heapq.heappush(waiting, r)
            index[r].append(at[a:b])

    if len(keys):
        add(np.flatnonzero(after[:n] < n))
    while waiting:
        rank = heapq.heappop(waiting)
        left, right, token = pairs[rank]
        at = np.unique(np.concatenate(index.pop(rank)))
        to = after[at]
        stands = (symbols[at] == left) & (symbols[to] == right)
        at, to = at[stands], to[stands]
        if left == right and len(at):
            # Of overlapping pairs every second one is merged, from the left.
            place = np.arange(len(at))
            starts = np.concatenate([[True], to[:-1] != at[1:]])
            merged = (place - np.maximum.accumulate(np.where(starts, place, 0))) % 2 == 0
            at, to = at[merged], to[merged]
        if not len(at):
            continue
        last = after[to]
        symbols[at], symbols[to] = token, -1
        after[at], before[last] = last, at
        after[n], before[n] = n, n
        prior = before[at]
        add(np.unique(np.concatenate([at[last < n], prior[prior < n]])))
    is_kept = symbols[:n] >= 0
    places = np.concatenate([[0], np.cumsum(is_kept)])
    flat = symbols[:n][is_kept].astype("<u4").tobytes()
    cuts = (4 * places[np.concatenate([[0], ends])]).tolist()
    return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


class Encoder:
    """Encodes texts and remembers the tokens of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}

    def parts(self, text: str) -> list[str]:
        special = self.vocabulary.special
        if special is None or not special.search(text):
            return [text]
        return special.split(text)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Tokens of every text, as little-endian 32-bit integers."""
        special = self.vocabulary.special_ids
        if len(self.known) > REMEMBERED:
            self.known = {}
        cut = []
        for text in texts:
            words: list[str] = []
            for part in self.parts(text or ""):
                words += [part] if part in special else self.vocabulary.cut(part)
            cut.append(words)
        known = self.known
        for content, token in special.items():
            known[content] = token
        new = list({word for words in cut for word in words if word not in known})
        known.update(zip(new, encode_words(new, self.vocabulary)))
        for words in cut:
            yield b"".join(map(known.__getitem__, words))


def decode(ids: bytes, vocabulary: Vocabulary) -> str:
    """The text of tokens, special ones included."""
    tokens = np.frombuffer(ids, dtype="<u4").tolist()
    return b"".join(map(vocabulary.bytes_of.__getitem__, tokens)).decode("utf-8", "replace")


def encode_column(df: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None,
                  with_ids: bool = True) -> DataFrame:
    """The columns ``keep`` and ``ids`` (array), ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    ``path`` is a vocabulary file of the tokenizers library, read on the driver. The ids are left out without
    ``with_ids``; both digests are of the bytes: ids as unsigned 32-bit little-endian integers, text as UTF-8.
    """
    vocabulary = Vocabulary(path)
    vocabulary.pair_table  # noqa: B018  a wrong vocabulary fails here
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    made = {"ids": ("array<bigint>", pa.list_(pa.int64()))} if with_ids else {}
    made |= {"n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()),
             "decoded_sha256": ("string", pa.string())}

    def start():
        vocabulary = shared.value

        def encode(texts):
            out: dict[str, list] = {c: [] for c in made}
            for ids in vocabulary.encoder.encode(texts):
                if with_ids:
                    out["ids"].append(np.frombuffer(ids, dtype="<u4").astype(np.int64))
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decode(ids, vocabulary).encode()).hexdigest())
            return out

        return encode

    keep = [c for c in df.columns if c != text_col] if keep is None else keep
    return with_columns_of_texts(df, text_col, keep, made, start)
