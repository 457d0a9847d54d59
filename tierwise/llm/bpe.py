"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs.

The leaves of a word's tree are the ranks of its adjacent symbol pairs, each combined with its
position; an inner node has the smaller of its children, so the root is the leftmost pair of
lowest rank.  A merge changes three leaves at most, each in a logarithmic number of steps, until
the root says that no pair can be merged.  Words of ordinary length are merged many at a time,
one tree a row of a matrix; longer ones (``LONG``) by the same steps on one tree.

The vocabulary is that of ``word_bpe_49k.json``: NFC, white space dropped, lower case by code
point, words ending in ``</w>``, byte-level symbols, special tokens matched in the raw text.
Decoding joins the tokens' strings with a blank: that file names no decoder.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from tokenizers import Regex
from tokenizers.normalizers import Lowercase
from tokenizers.pre_tokenizers import Split

from tierwise.llm.common import id_and_text, map_slices

#: Symbols above which a word gets a tree of its own instead of a row of a matrix.
LONG = 64
#: Words whose ids are remembered by a worker; beyond it, memory is emptied and filled anew.
REMEMBERED = 400_000
#: No pair: above any rank and position.
NONE = np.int64(1) << 62
# Fixed value: the word pattern of the vocabulary file.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def _classes(limit: int) -> tuple[str, str]:
    """Letters and numbers below a code point, as the inside of a character class."""
    kinds = {k: "".join(re.escape(c) for c in map(chr, range(limit)) if unicodedata.category(c)[0] == k) for k in "LN"}
    return kinds["L"], kinds["N"]


#: Below this code point the standard library's regular expressions do, which are faster.
NEAR = 0x250
_LETTER, _NUMBER = _classes(NEAR)
NEAR_WORD = re.compile(rf"{CONTRACTIONS}|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")
NEAR_ONLY = re.compile(f"[\0-{chr(NEAR - 1)}]*")
#: White space for str but not for the vocabulary's pattern.
SEPARATORS = re.compile("[\x1c-\x1f]")
#: For other texts, with the Unicode version that the vocabulary's tokenizer has.
FAR_WORDS = Split(Regex(rf"{CONTRACTIONS}|\p{{L}}+|\p{{N}}|[^\s\p{{L}}\p{{N}}]+"), "removed", invert=True)
LOWER = Lowercase()


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it can be seen, else one from U+0100 on."""
    seen = [b for r in ((33, 127), (161, 173), (174, 256)) for b in range(*r)]
    table = {b: chr(b) for b in seen}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(seen))
    return [table[b] for b in range(256)]


def normalised(text: str) -> str:
    """NFC and lower case by code point, which ``str.lower`` is for all but far letters."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    if NEAR_ONLY.fullmatch(text):
        return text.lower()
    return LOWER.normalize_str(text)


class WordBpe:
    """The vocabulary of one file, and the encodings of the words met so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], dtype=np.int64)
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]]
        self.rank_of = {(a, b): rank for rank, (a, b, _) in enumerate(pairs)}
        self.merged = np.array([c for _, _, c in pairs], dtype=np.int64)
        keys = np.array([(a << 32) | b for a, b, _ in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        self.known: dict[str, tuple[int, ...]] = {}

    # ---- text to words

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        text = normalised(text)
        if NEAR_ONLY.fullmatch(text) and not SEPARATORS.search(text):
            return NEAR_WORD.findall(text)
        return [word for word, _ in FAR_WORDS.pre_tokenize_str(text)]

    def parts(self, text: str) -> list[str]:
        """Words and special tokens, in order; no word is equal to a special token, which has a
        letter beside a sign."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return self.words(text)
        found: list[str] = []
        for piece in self.special_pattern.split(text):
            found.extend([piece] if piece in self.special else self.words(piece))
        return found

    # ---- ids and back

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        parts = [self.parts(t) for t in texts]
        words = set().union(*parts)
        if len(self.known) + len(words) > REMEMBERED:
            self.known = {}
        self.learn(sorted(w for w in words if w not in self.known))
        return [list(chain.from_iterable(map(self.known.__getitem__, each))) for each in parts]

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))

    def learn(self, words: list[str]) -> None:
        """Encode words and remember their ids."""
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            if word in self.special:
                self.known[word] = (self.special[word],)
            elif len(raw) > LONG:
                self.known[word] = tuple(self.merge_long(raw))
            else:
                by_size.setdefault(max(1, (len(raw) - 1).bit_length()), []).append((word, raw))
        for bits, group in by_size.items():
            for (word, _), ids in zip(group, self.merge_many([raw for _, raw in group], 1 << bits), strict=True):
                self.known[word] = ids

    def ranks(self, left: np.ndarray, right: np.ndarray, position: np.ndarray, width: int) -> np.ndarray:
        """Leaves: rank and position of each pair, or NONE."""
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at] * width + position, NONE)

    def merge_many(self, raws: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Ids of words of at most ``width`` bytes: one segment tree of ``width`` leaves for each row."""
        n = len(raws)
        sizes = np.array([len(r) for r in raws])
        cells = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), dtype=np.uint8).reshape(n, width)
        column = np.arange(width)
        symbol = np.where(column == sizes[:, None] - 1, self.last[cells], self.inner[cells])
        symbol[column >= sizes[:, None]] = -1
        after = np.where(column + 1 < sizes[:, None], column + 1, -1)
        before = np.broadcast_to(column - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), NONE)
        tree[:, width : 2 * width - 1] = self.ranks(
            symbol[:, :-1], np.maximum(symbol[:, 1:], 0), column[:-1], width
        )
        tree[:, width : 2 * width - 1][after[:, :-1] < 0] = NONE
        size = width
        while size > 1:
            level = tree[:, size : 2 * size]
            tree[:, size // 2 : size] = np.minimum(level[:, ::2], level[:, 1::2])
            size //= 2

        def put(rows: np.ndarray, at: np.ndarray, leaf: np.ndarray) -> None:
            node = at + width
            tree[rows, node] = leaf
            while node[0] > 1:  # every leaf has the same depth
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        def leaf_of(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            follower = after[rows, at]
            found = self.ranks(symbol[rows, at], np.maximum(symbol[rows, follower], 0), at, width)
            return np.where(follower >= 0, found, NONE)

        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            root = tree[rows, 1]
            at = root & (width - 1)
            gone = after[rows, at]
            symbol[rows, at] = self.merged[root // width]
            symbol[rows, gone] = -1
            follower = after[rows, gone]
            after[rows, at] = follower
            has = follower >= 0
            before[rows[has], follower[has]] = at[has]
            put(rows, gone, np.full(len(rows), NONE))
            put(rows, at, leaf_of(rows, at))
            ahead = before[rows, at]
            has = ahead >= 0
            if has.any():
                put(rows[has], ahead[has], leaf_of(rows[has], ahead[has]))
            rows = rows[tree[rows, 1] < NONE]
        left = symbol >= 0
        ends = np.cumsum(left.sum(1)).tolist()
        ids = symbol[left].tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def merge_long(self, raw: bytes) -> list[int]:
        """The same steps for one word, of any length."""
        n = len(raw)
        symbol = [int(self.inner[b]) for b in raw[:-1]] + [int(self.last[raw[-1]])]
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        width = 1 << (n - 1).bit_length()
        none = int(NONE)
        rank_of, merged = self.rank_of, self.merged

        def leaf_of(at: int) -> int:
            rank = rank_of.get((symbol[at], symbol[after[at]])) if after[at] >= 0 else None
            return none if rank is None else rank * width + at

        tree = [none] * width + [leaf_of(i) for i in range(n)] + [none] * (width - n)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(at: int, leaf: int) -> None:
            node = at + width
            tree[node] = leaf
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    return
                tree[node] = low

        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            gone = after[at]
            symbol[at], symbol[gone] = int(merged[rank]), -1
            after[at] = after[gone]
            if after[at] >= 0:
                before[after[at]] = at
            put(gone, none)
            put(at, leaf_of(at))
            if before[at] >= 0:
                put(before[at], leaf_of(before[at]))
        return [s for s in symbol if s >= 0]


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The vocabulary of a file; a worker reads it once and keeps its words from task to task."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def hex_digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


#: Columns that ``encode`` can give, each from a text's ids.
OUTPUTS = {
    "ids": ("array<int>", lambda bpe, ids: ids),
    "n_tokens": ("long", lambda bpe, ids: len(ids)),
    "decoded": ("string", lambda bpe, ids: bpe.decode(ids)),
    "ids_sha256": ("string", lambda bpe, ids: hex_digest(" ".join(map(str, ids)))),
    "decoded_sha256": ("string", lambda bpe, ids: hex_digest(bpe.decode(ids))),
}


def encode(docs: DataFrame, vocabulary: str, outputs: tuple[str, ...] = ("ids", "n_tokens")) -> DataFrame:
    """``doc_id`` and the wanted ``OUTPUTS`` of each row's whole text.

    ``vocabulary`` is the path of the vocabulary file on the executors.  A null text is the empty
    one and has no ids.  Every row gives a row, repeated ones and those without ``doc_id`` too;
    other columns of ``docs`` are not read.  No shuffle.
    """
    made = [(name, *OUTPUTS[name]) for name in outputs]

    def work():
        bpe = load(vocabulary)

        def handle(rows: dict[str, list]) -> dict[str, list]:
            all_ids = bpe.encode_all(rows["text"])
            return {"doc_id": rows["doc_id"]} | {name: [f(bpe, ids) for ids in all_ids] for name, _, f in made}

        return handle

    schema = ", ".join(["doc_id long", *(f"{name} {kind}" for name, kind, _ in made)])
    return map_slices(id_and_text(docs), work, schema)


def decode(frame: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and the ``decoded`` text of each row's ids; null ids decode to the empty text."""

    def work():
        bpe = load(vocabulary)
        return lambda rows: {"doc_id": rows["doc_id"], "decoded": [bpe.decode(ids or []) for ids in rows["ids"]]}

    narrow = frame.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{ids_col}` ids")
    return map_slices(narrow, work, "doc_id long, decoded string")
