"""Byte-level BPE through a tokenization automaton. [operator 13]

The automaton's arcs carry tokens. It starts with one state and a loop for each byte.
Merges are compiled into it one after the other, each by the same gadget for its pair
``(u, v)`` and the new token ``w``:

* wherever an arc ``u`` leaves a state, an arc ``w`` leaves it too, to where ``v`` leads;
* the state that ``u`` leads to is split: behind ``u`` there is no arc ``v`` any more.

All arcs with one token lead to one state, so states are named by tokens, and after the
last merge exactly one path spells any string of bytes: its BPE tokenization. Written
out, the table would have 2.5 billion cells for 50,000 merges. A gadget only copies a
row and a column of the table and clears a cell, so it is kept as just that: what was
copied, when, and the cell. Cells are worked out from the gadgets when a transition
first needs them, and stay in the table.

A word is encoded by one run over its bytes. A position holds the one state that the
bytes before it lead to; the tokens that start there are followed in a trie of arc
labels, and those with an arc in the table move on. The labels of the path are the ids;
decoding emits the bytes of the labels.

Text is split into words before, by the fixed pattern of the vocabulary. Special tokens
in a text are found first and become their own ids.

Cases: a null text counts as empty and has no tokens. Text and word may be of any
length: time is linear in it. Bytes that do not make a character decode to U+FFFD. Rows
that repeat are encoded alike. An empty table gives an empty result. Only id and text
are read, so further columns cannot clash. A vocabulary that lacks a byte, makes a token
by two merges, or merges a token before it is made is refused.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import ship

# Fixed value: the pattern that splits text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Words that a worker remembers, twice, and cells of the table that it keeps. Both start
# anew when they are full, which changes no result.
REMEMBERED_WORDS = 350_000
REMEMBERED_LENGTH = 64
TABLE_CELLS = 4_000_000
# Bytes of text whose tokens are returned together.
SLICE = 4_000_000

START = -1


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary's file.

    Printable bytes stand for themselves, the others for characters from U+0100 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Automaton:
    """The table of arcs between tokens, compiled from ``merges`` of ids in their order."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        made = {w for _, _, w in merges}
        single = {labels[i]: i for i in labels if i not in made and len(labels[i]) == 1}
        if len(single) != 256:
            raise ValueError("the vocabulary must have each of the 256 bytes")
        self.labels = labels
        # Of a merged token: its parts and when its gadget was added.
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born = dict.fromkeys(single.values(), -1)
        self.cut: dict[tuple[int, int], int] = {}
        self.dead: set[int] = set()
        self.cells: dict[int, dict[int, bool]] = {}
        self.n_cells = 0
        for time, (u, v, w) in enumerate(merges):
            self._add_gadget(time, u, v, w)
        self._build_trie()

    def _add_gadget(self, time: int, u: int, v: int, w: int) -> None:
        if u not in self.born or v not in self.born or w in self.born:
            raise ValueError(f"merge {time} uses a token before it is made, or makes one again")
        # Where no arc v is left behind u, the pair never stands side by side.
        if u in self.dead or v in self.dead or not self._arc(u, v):
            self.dead.add(w)
        self.left[w], self.right[w], self.born[w] = u, v, time
        self.cut[u, v] = time

    def _arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow in ``state``, from the gadgets added so far.

        A state made by a merge has the arcs that its right part's state had just before
        the gadget; a token made by a merge leaves the states that its left part left
        just after it. Twice the time, and one more for "after", orders both.
        """
        born, cut, now = self.born, self.cut, 1 << 60
        while True:
            gone = cut.get((state, token))
            if gone is not None and 2 * gone < now:
                return False
            of_state, of_token = born[state], born[token]
            if of_state < 0 and of_token < 0:
                return True
            if of_state > of_token:
                now, state = 2 * of_state, self.right[state]
            else:
                now, token = 2 * of_token + 1, self.left[token]

    def row(self, state: int) -> dict[int, bool]:
        """The row of the table for a state, with the cells that were needed so far."""
        if state not in self.cells:
            if self.n_cells >= TABLE_CELLS:
                self.cells, self.n_cells = {}, 0
            self.cells[state] = {}
        return self.cells[state]

    def _build_trie(self) -> None:
        """The arc labels as a trie: ``step[node, byte]`` and the token that ends at a node."""
        self.step: dict[int, int] = {}
        self.token_at = [START]
        self.whole: dict[bytes, int] = {}
        for token in self.born:
            if token in self.dead:
                continue
            self.whole[self.labels[token]] = token
            node = 0
            for byte in self.labels[token]:
                following = self.step.get(node << 8 | byte)
                if following is None:
                    following = self.step[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(START)
                node = following
            self.token_at[node] = token

    def encode(self, word: bytes) -> list[int]:
        """The tokens of the only path that spells ``word``."""
        if word in self.whole:
            return [self.whole[word]]
        step, token_at, n = self.step, self.token_at, len(word)
        state, back = [START] * (n + 1), [0] * (n + 1)
        for i in range(n):
            here, node = state[i], 0
            row = self.row(here) if i else None
            for j in range(i, n):
                node = step.get(node << 8 | word[j])
                if node is None:
                    break
                token = token_at[node]
                if token == START or state[j + 1] != START:
                    continue
                follows = not i or row.get(token)
                if follows is None:
                    follows = row[token] = self._arc(here, token)
                    self.n_cells += 1
                if follows:
                    state[j + 1], back[j + 1] = token, i
        path = []
        while n:
            path.append(state[n])
            n = back[n]
        return path[::-1]


class Splitter:
    """Cuts text at special tokens, and the rest into words by the pattern."""

    def __init__(self, special: dict[str, int]):
        import regex

        self.special = special
        longest = sorted(special, key=len, reverse=True)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if special else None
        self.plain = regex.compile(PATTERN)
        newer = self._newer(regex)
        self.has_newer = regex.compile(f"[{newer}]") if newer else None
        letter, digit = rf"(?:(?![{newer}])\p{{L}})", rf"(?:(?![{newer}])\p{{N}})"
        other = rf"(?:[^\s\p{{L}}\p{{N}}]|[{newer}])"
        careful = PATTERN.replace(r"\p{L}+", letter + "+").replace(r"\p{N}+", digit + "+").replace(
            r"[^\s\p{L}\p{N}]+", other + "+")
        self.careful = regex.compile(careful) if newer else self.plain

    @staticmethod
    def _newer(regex) -> str:
        """Characters, as a class, that ``regex`` calls letters or digits and the vocabulary's library does not.

        Both know Unicode, of different years. Asked are the characters that Python's own
        tables do not know either.
        """
        import sys
        import unicodedata

        from tokenizers import pre_tokenizers

        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        known = regex.compile(r"[\p{L}\p{N}]")
        letter = regex.compile(r"\p{L}")
        found = []
        for c in map(chr, range(0x80, sys.maxunicode + 1)):
            if unicodedata.category(c) == "Cn" and known.match(c):
                beside = "a" if letter.match(c) else "1"
                if len(split(beside + c)) > 1:
                    found.append(ord(c))
        spans: list[list[int]] = []
        for c in found:
            if spans and c == spans[-1][1] + 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)

    def words(self, text: str) -> list[str]:
        if self.has_newer is None or text.isascii() or not self.has_newer.search(text):
            return self.plain.findall(text)
        return self.careful.findall(text)

    def parts(self, text: str) -> Iterator[tuple[int | None, str]]:
        """``(id, text)`` of special tokens, ``(None, text)`` of what stands between them."""
        if self.at_special is None or not any(s in text for s in self.special):
            yield None, text
            return
        for piece in self.at_special.split(text):
            if piece:
                yield self.special.get(piece), piece


class Met(dict):
    """The packed tokens of the words that this worker has met; a new word is encoded.

    When it is full its words become the earlier ones, of which those that are met again
    are kept.
    """

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton
        self.earlier: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        tokens = self.earlier.get(word)
        if tokens is None:
            tokens = packed_ids(self.automaton.encode(word.encode("utf-8", "surrogatepass")))
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED_WORDS:
                self.earlier = dict(self)
                self.clear()
            self[word] = tokens
        return tokens


def packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Tokenizer:
    """An automaton with its splitter and the words that this worker has met."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as source:
            data = json.load(source)
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        to_byte = byte_characters()
        labels = {i: bytes(to_byte[c] for c in token) for token, i in vocab.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.automaton = Automaton(labels, [(vocab[u], vocab[v], vocab[u + v]) for u, v in pairs])
        special = {t["content"]: t["id"] for t in data.get("added_tokens", ())}
        self.splitter = Splitter(special)
        self.emitted = labels | {i: token.encode() for token, i in special.items()}
        self.met = Met(self.automaton)

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, packed."""
        tokens = []
        for special, part in self.splitter.parts(text or ""):
            if special is None:
                tokens += map(self.met.__getitem__, self.splitter.words(part))
            else:
                tokens.append(packed_ids([special]))
        return b"".join(tokens)

    def decode(self, tokens: bytes | None) -> str:
        ids = struct.unpack(f"<{len(tokens or b'') // 4}I", tokens or b"")
        return b"".join(map(self.emitted.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(file: str) -> Tokenizer:
    """The tokenizer of ``file``, compiled once in a worker."""
    if file not in _LOADED:
        _LOADED[file] = Tokenizer(file)
    return _LOADED[file]


def _mapped(rows: DataFrame, source: str, result: str, kind: str, work) -> DataFrame:
    """``rows`` with the column ``result``, which ``work`` makes of each value of ``source``.

    Rows go back in slices of bounded size.
    """
    names = [*rows.columns, result]

    def each(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        out = pa.binary() if kind == "binary" else pa.string()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(source))
            start, size = 0, 0
            for i, length in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
                size += length
                if size >= SLICE or i + 1 == len(column):
                    part = batch.slice(start, i + 1 - start)
                    made = pa.array([work(x.as_py()) for x in column.slice(start, i + 1 - start)], out)
                    yield pa.RecordBatch.from_arrays([*part.columns, made], names=names)
                    start, size = i + 1, 0

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", {result} {kind}"
    return rows.mapInArrow(each, schema)


def encode(docs: DataFrame, file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, tokens)``: the ids as little-endian unsigned 32-bit integers, the form of token files."""
    ship(docs.sparkSession)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _mapped(rows, "text", "tokens", "binary", lambda text: tokenizer(file).encode(text)).select("doc_id", "tokens")


def decode(encoded: DataFrame, file: str) -> DataFrame:
    """``encoded(doc_id, tokens)`` with ``decoded``, the text that the ids spell."""
    ship(encoded.sparkSession)

    return _mapped(encoded.select("doc_id", "tokens"), "tokens", "decoded", "string",
                   lambda tokens: tokenizer(file).decode(tokens))


def n_tokens(tokens: str = "tokens"):
    return (F.octet_length(tokens) / 4).cast("long")
