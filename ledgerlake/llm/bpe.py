"""Byte-level BPE encoding and decoding by a traversal of a trie of words.

A text is cut at the special tokens and then into words (the byte-level pattern).  The
distinct words of a slice of texts go into a trie with bytes on its edges, which is walked
depth first.  Every node on the way carries one state, the last token of its prefix's
encoding, and this is enough: the tokens before it are the encoding of the shorter prefix
that it leaves, whose state lies further up the path.  So what words share is encoded once.

The last token of a prefix is the one token that ends it and whose neighbour, the last
token of what stands before, does not merge with it: the two tokens' bytes, merged by the
ranks alone, give just these two again.  That is exact, because no merge of a whole
encoding crosses the border of two of its tokens.

The vocabulary (a file of fixed size, ``Vocabulary.load``) is broadcast; each Python worker
builds its tables once and keeps the encodings of ``CACHED_WORDS`` words.  Texts are
encoded where they are read: no shuffle, and a lost executor costs its own tasks.

Characters that Python's Unicode tables do not know may fall into other classes in the
tokenizers library; texts with such characters are cut by the library's own pre-tokenizer.

Defined results: a null or empty text has no tokens and decodes to the empty text; ids that
the vocabulary lacks decode to nothing, bytes that are no UTF-8 to U+FFFD; repeated rows are
encoded each for itself; an empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import byte_slices, pick, worker_cache

CACHED_WORDS = 500_000     # encodings a worker keeps
CACHED_PAIRS = 1_000_000   # token pairs a worker knows to be neighbours or not
SLICE_ROWS, SLICE_BYTES = 2_000, 4 << 20      # texts whose distinct words make one trie

# Fixed value: the public pattern that cuts text into words before byte-level merges, the alternative that letters take first
# (no other one can start where it does), and what it comes to in ASCII.
PATTERN = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = r" ?[A-Za-z]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable letter: its own, or the next free one from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """``tokens``: bytes by id (None: no such id); ``merges``: pairs of ids by rank with the id they make; ``special``: text -> id."""
    tokens: tuple[bytes | None, ...]
    merges: tuple[tuple[int, int, int], ...]
    special: tuple[tuple[str, int], ...]

    @staticmethod
    def load(path: str) -> Vocabulary:
        """A byte-level BPE file of the tokenizers library.  Settings that this operator does not know are an error."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre, post = spec["model"], spec["pre_tokenizer"] or {}, spec["decoder"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback") if model.get(k)]
        odd += [t["content"] for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"]]
        if odd or model["type"] != "BPE" or spec["normalizer"] or pre.get("type") != "ByteLevel" or post.get("type") != "ByteLevel" \
                or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path}: not a plain byte-level BPE file {odd}")
        letters = _byte_of_letter()
        raw = {k: bytes(letters[c] for c in k) for k in model["vocab"]}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens: list[bytes | None] = [None] * (1 + max([*model["vocab"].values(), *special.values()]))
        for k, i in model["vocab"].items():
            tokens[i] = raw[k]
        if len({t for t in tokens if t and len(t) == 1}) < 256:
            raise ValueError(f"{path}: some bytes are no tokens")
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        of = model["vocab"]
        for k, i in special.items():
            tokens[i] = k.encode()
        return Vocabulary(tuple(tokens), tuple((of[a], of[b], of[a + b]) for a, b in merges), tuple(special.items()))


# ---------------------------------------------------------------- a worker's tables
class _Trie:
    """Distinct words; an edge holds the bytes up to the next branch or word end."""

    def __init__(self, words: list[bytes]):
        self.label, self.below, self.word = [b""], [{}], [-1]
        for i, w in enumerate(words):
            self._insert(w, i)

    def _node(self, label: bytes, below: dict[int, int], word: int) -> int:
        self.label.append(label)
        self.below.append(below)
        self.word.append(word)
        return len(self.label) - 1

    def _insert(self, word: bytes, index: int) -> None:
        node, at, size, labels, belows = 0, 0, len(word), self.label, self.below
        while at < size:
            below = belows[node]
            child = below.get(word[at])
            if child is None:
                below[word[at]] = self._node(word[at:], {}, index)
                return
            label = labels[child]
            if not word.startswith(label, at):            # the edge branches, or the word ends on it
                same = 1
                while at + same < size and label[same] == word[at + same]:
                    same += 1
                upper = below[word[at]] = self._node(label[:same], {label[same]: child}, -1)
                labels[child] = label[same:]
                node, at = upper, at + same
            else:
                node, at = child, at + len(label)
        self.word[node] = index


class _Tables:
    """Look-ups of a vocabulary, and the encodings that this worker has seen."""

    def __init__(self, vocabulary: Vocabulary):
        special = dict(vocabulary.special)
        plain = set(special.values())
        self.size = [len(t or b"") for t in vocabulary.tokens]
        self.tokens = vocabulary.tokens
        self.rank = {(a, b): (i, c) for i, (a, b, c) in reversed(list(enumerate(vocabulary.merges)))}
        self.single = {t[0]: i for i, t in enumerate(vocabulary.tokens) if t and len(t) == 1 and i not in plain}
        self._endings({t: i for i, t in enumerate(vocabulary.tokens) if t and i not in plain})
        self.special = {k: np.int32(i).tobytes() for k, i in special.items()}
        longest = sorted(special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if special else None
        self.words, self.ascii_words = regex.compile(PATTERN), re.compile(ASCII_PATTERN, re.ASCII)
        self.letters: set[str] = set()                    # characters known to be assigned
        self.library = None
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}                 # encodings of the words seen of late
        self.older: dict[str, bytes] = {}                 # and of those before

    def _endings(self, tokens: dict[bytes, int]) -> None:
        """Which tokens end a prefix: an automaton over the tokens' bytes (``step``, ``fail``), the longest token that
        ends at each of its nodes, and the longest one that is a proper ending of a token."""
        step: dict[int, int] = {}
        self.step, self.fail, self.longest, self.shorter = step, [0], [-1], [-1] * len(self.tokens)
        own, levels = {}, {}
        for t, i in tokens.items():
            node = 0
            for depth, byte in enumerate(t):
                nxt = step.get(node << 8 | byte)
                if nxt is None:
                    nxt = step[node << 8 | byte] = len(self.fail)
                    self.fail.append(0)
                    self.longest.append(-1)
                    levels.setdefault(depth, []).append((node, byte, nxt))
                node = nxt
            own[node] = i
        for depth in sorted(levels):
            for parent, byte, node in levels[depth]:
                back = self._after(self.fail[parent], byte) if parent else 0
                self.fail[node] = back
                self.longest[node] = own.get(node, self.longest[back])
                if node in own:
                    self.shorter[own[node]] = self.longest[back]

    def _after(self, node: int, byte: int) -> int:
        while True:
            nxt = self.step.get(node << 8 | byte)
            if nxt is not None:
                return nxt
            if not node:
                return 0
            node = self.fail[node]

    def merged(self, text: bytes) -> list[int]:
        """Encoding of a short text by the merges' ranks, the lowest and leftmost first."""
        out, rank = [self.single[b] for b in text], self.rank.get
        while True:
            best = None
            for i, pair in enumerate(zip(out, out[1:], strict=False)):
                found = rank(pair)
                if found and (best is None or found < best):
                    best, at = found, i
            if best is None:
                return out
            out[at:at + 2] = [best[1]]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are side by side (``left`` -1: ``right`` stays one token by itself)."""
        ok = self.pairs.get(left << 32 | right)
        if ok is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            have = [right] if left < 0 else [left, right]
            ok = self.pairs[left << 32 | right] = self.merged(b"".join(self.tokens[t] for t in have)) == have
        return ok

    def encodings(self, words: list[bytes]) -> list[bytes]:
        """Token ids (int32 bytes) of each of the distinct words."""
        trie, out = _Trie(words), [b""] * len(words)
        step, fail, longest, shorter, size, pairs = self.step.get, self.fail, self.longest, self.shorter, self.size, self.pairs
        last, at = [-1], [0]          # by length: last token of the path's prefix, node of the automaton
        todo = [(0, 0)]
        while todo:
            node, n = todo.pop()
            del last[n + 1:], at[n + 1:]
            state = at[n]
            for byte in trie.label[node]:
                n += 1
                while (nxt := step(state << 8 | byte)) is None and state:
                    state = fail[state]
                state = nxt or 0
                at.append(state)
                token = longest[state]
                while True:                               # the longest ending token that its left neighbour lets be
                    left = last[n - size[token]]
                    fits = pairs.get(left << 32 | token)
                    if fits or fits is None and self.neighbours(left, token):
                        break
                    token = shorter[token]
                last.append(token)
            if trie.word[node] >= 0:
                ids, left = array("i"), n
                while left:
                    ids.append(last[left])
                    left -= size[last[left]]
                ids.reverse()
                out[trie.word[node]] = ids.tobytes()
            for child in trie.below[node].values():
                todo.append((child, n))
        return out

    def _assigned(self, text: str) -> bool:
        new = set(text) - self.letters
        odd = {c for c in new if unicodedata.category(c) == "Cn"}
        self.letters |= new - odd
        return not odd

    def _pieces(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words.findall(text)
        if self._assigned(text):
            return self.words.findall(text)
        if self.library is None:
            from tokenizers import pre_tokenizers
            self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:z] for _, (a, z) in self.library.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut.split(t) if self.cut else [t] for t in texts]
        pieces = [[p if p in self.special else self._pieces(p) for p in parts] for parts in cut]
        seen: set[str] = set()
        for parts in pieces:
            for p in parts:
                if not isinstance(p, str):
                    seen.update(p)
        if len(self.known) > CACHED_WORDS // 2:
            self.known, self.older = {}, self.known
        new = []
        for w in seen.difference(self.known):
            ids = self.older.get(w)
            if ids is None:
                new.append(w)
            else:
                self.known[w] = ids
        self.known.update(zip(new, self.encodings([w.encode() for w in new]), strict=True))
        of = self.known.__getitem__
        return [b"".join(self.special[p] if isinstance(p, str) else b"".join(map(of, p)) for p in parts) for parts in pieces]


# ---------------------------------------------------------------- operators
def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    key = f"bpe:{hash(vocabulary)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = worker_cache(key, lambda: _Tables(shared.value))
        for batch in batches:
            for part, texts in byte_slices(batch, rows=SLICE_ROWS, size=SLICE_BYTES):
                ids = tables.encode([t.decode("utf-8", "replace") for t in texts])
                ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "ids"])

    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def _texts(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """The tokens' bytes of each row one after the other, as text."""
    flat, ends = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    raw = tokens.take(pa.array(np.where((flat < 0) | (flat >= len(tokens) - 1), len(tokens) - 1, flat)))
    _, offsets, data = raw.buffers()
    at = np.frombuffer(offsets, np.int32, len(raw) + 1)[ends - ends[0]]
    texts = pa.Array.from_buffers(pa.string(), len(ids), [None, pa.py_buffer(at.copy()), data or pa.py_buffer(b"")])
    try:
        texts.validate(full=True)
        return texts
    except pa.ArrowInvalid:                               # some bytes are no UTF-8
        return pa.array([t.decode("utf-8", "replace") for t in texts.cast(pa.binary()).to_pylist()], pa.string())


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with the decoded ``text``; special tokens are kept."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array([t or b"" for t in shared.value.tokens] + [b""], pa.binary())      # the last one stands for ids that the vocabulary lacks
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), _texts(part.column("ids"), tokens)], names=["doc_id", "ids", "text"])

    rows = pick(encoded, doc_id="doc_id", ids="ids").select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
