"""Token counts by dynamic programming over prefixes.

A byte-pair encoding splits a text into pieces and merges inside each piece. The last token of the
encoding of a prefix is the one token ending there that fits behind the last token of the shorter
prefix; two tokens fit if encoding their bytes together gives just these two. So one pass over the
ends of a piece gives the exact token count of *every* prefix, and a text's counts are running
sums over its pieces. Truncation and budget questions are then look-ups: no text is encoded again.

The pass runs for all new pieces of a batch at once with numpy, and each worker remembers pieces.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.arrays import utf8

from tidemark.llm.arrays import mix

# How byte-level tokenizers of this family split a text before merging (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts of ASCII and Latin letters, whose classes are short enough to write out.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_NOT_SIMPLE = re.compile(rf"[^\x00-\x1b\x20-\x7f{_LETTERS}]")
_SIMPLE_SPLIT = re.compile(
    rf" ?[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\t-\r {_LETTERS}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
_BLANK = regex.compile(r"\s+")
_CONTRACTIONS = ("'re", "'ve", "'ll")
_REMEMBERED = 400_000
_BASE = np.uint64(0x100000001B3)
# Longer pieces are few, so they are passed one by one: a step for all pieces at once costs as much as for one.
LONG_PIECE = 256


def _byte_characters() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Token counts of prefixes, as the tokenizer in a ``tokenizers`` JSON file encodes them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is not a byte-level BPE without normalizer")
        if spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"{path} adds a space before the text, which prefixes do not have")
        to_byte = _byte_characters()
        as_bytes = {t: bytes(to_byte[c] for c in t) for t in spec["model"]["vocab"] if all(c in to_byte for c in t)}
        ids = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(ids[a], ids[b]): (r, ids[a + b]) for r, (a, b) in enumerate(merges)}
        reachable = {ids[a + b] for a, b in merges} | {i for t, i in ids.items() if len(as_bytes.get(t, b"")) == 1}
        self.tokens = {i: as_bytes[t] for t, i in ids.items() if t in as_bytes and i in reachable}
        self.of_byte = np.zeros(256, np.int64)
        for i, b in self.tokens.items():
            if len(b) == 1:
                self.of_byte[b[0]] = i
        # Added tokens are cut out of a text before it is split, longest first.
        added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.split = regex.compile(SPLIT)
        self.longest = max(map(len, self.tokens.values()))
        # Per length, the tokens by the hash of their bytes, sorted.
        self.by_length = {}
        for n in range(1, self.longest + 1):
            if members := [(self._hash(b), i) for i, b in self.tokens.items() if len(b) == n]:
                members.sort()
                self.by_length[n] = (np.array([m[0] for m in members], np.uint64), np.array([m[1] for m in members], np.int64))
        self.endings: dict[bytes, int | None] | None = None
        self.fits: dict[int, bool] = {}
        self.counts: dict[str, int] = {}

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_BASE) + b + 1) % 2**64
        return h

    def _merge(self, ids: list[int]) -> list[int]:
        """Merges in rank order, from single bytes."""
        while len(ids) > 1:
            best = min(((self.rank[p][0], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.rank), default=None)
            if best is None:
                break
            k = best[1]
            ids[k : k + 2] = [self.rank[ids[k], ids[k + 1]][1]]
        return ids

    def _pair_fits(self, pairs: np.ndarray) -> np.ndarray:
        """Whether ``left * 2**32 + right`` stay two tokens when encoded together."""
        values, inverse = np.unique(pairs, return_inverse=True)
        out = np.array([self._fit(pair) for pair in values.tolist()], bool)
        return out[inverse]

    def _fit(self, pair: int) -> bool:
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) > 4 * _REMEMBERED:
                self.fits.clear()
            left, right = pair >> 32, pair & 0xFFFFFFFF
            ids = [int(self.of_byte[b]) for b in self.tokens[left] + self.tokens[right]]
            known = self.fits[pair] = self._merge(ids) == [left, right]
        return known

    def _scan(self, piece: bytes) -> list[int]:
        """Token counts of the prefixes of one long piece. Looking back from an end stops where no token ends so."""
        if self.endings is None:
            self.endings = {b[k:]: None for b in self.tokens.values() for k in range(len(b))}
            self.endings.update((b, i) for i, b in self.tokens.items())
        last, count = [-1] * (len(piece) + 1), [0] * (len(piece) + 1)
        for end in range(1, len(piece) + 1):
            for start in range(end - 1, max(end - self.longest, 0) - 1, -1):
                token = self.endings.get(piece[start:end], -1)
                if token == -1:
                    break
                if token is not None and (not start or self._fit((last[start] << 32) | token)):
                    last[end], count[end] = token, count[start] + 1
                    break
        return count

    def piece_counts(self, piece_list: list[bytes]) -> list[np.ndarray]:
        """For each piece, the token counts of its prefixes of 0, 1, ... bytes."""
        count, cell, length = self._prefix_pass(piece_list)
        return [count[c : c + n + 1] for c, n in zip(cell.tolist(), length.tolist(), strict=True)]

    def _prefix_pass(self, piece_list: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of all prefixes of all pieces, the place of each piece's empty prefix, and the lengths."""
        length = np.array([len(p) for p in piece_list], np.int64)
        if not len(length):
            return np.zeros(0, np.int32), length, length
        data = np.frombuffer(b"".join(piece_list), np.uint8).astype(np.uint64) + np.uint64(1)
        start = np.concatenate([[0], np.cumsum(length)])
        # Cell start[k] + k + i stands for the prefix of i bytes of piece k.
        cell = start[:-1] + np.arange(len(length))
        last, count = np.full(int(start[-1]) + len(length), -1, np.int64), np.zeros(int(start[-1]) + len(length), np.int32)
        for k in np.flatnonzero(length > LONG_PIECE).tolist():
            count[cell[k] : cell[k] + length[k] + 1] = self._scan(piece_list[k])
        together = np.where(length > LONG_PIECE, 0, length)
        by_length = np.argsort(-together, kind="stable")
        live = np.searchsorted(-together[by_length], -np.arange(int(together.max()) + 1), "right")
        for i in range(1, int(together.max()) + 1):
            todo = by_length[: live[i]]  # pieces of i bytes or more
            h, power = np.zeros(len(todo), np.uint64), np.uint64(1)
            open_ = np.ones(len(todo), bool)
            for n in range(1, min(i, self.longest) + 1):
                with np.errstate(over="ignore"):
                    h = h + data[start[todo] + i - n] * power
                    power = power * _BASE
                if n not in self.by_length:
                    continue
                keys, ids = self.by_length[n]
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                found = np.flatnonzero(open_ & (keys[at] == h))
                if not len(found):
                    continue
                token, before = ids[at[found]], cell[todo[found]] + i - n
                good = np.ones(len(found), bool)
                if i > n:
                    good = self._pair_fits((last[before] << np.int64(32)) | token)
                hit = found[good]
                here = cell[todo[hit]] + i
                last[here], count[here] = token[good], count[before[good]] + 1
                open_[hit] = False
        return count, cell, length

    def _learn(self, new: list[str]) -> None:
        for k in range(0, len(new), 100_000):
            part = new[k : k + 100_000]
            count, cell, length = self._prefix_pass([p.encode() for p in part])
            self.counts.update(zip(part, count[cell + length].tolist(), strict=True))

    def _stretches(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between added tokens, and these tokens."""
        at = 0
        for m in self.added.finditer(text) if self.added else ():
            yield text[at : m.start()], False
            yield m.group(), True
            at = m.end()
        yield text[at:], False

    def pieces(self, text: str) -> list[str]:
        return (self.split if _NOT_SIMPLE.search(text) else _SIMPLE_SPLIT).findall(text)

    def totals(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text: the count of its longest prefix."""
        out: list[int] = []
        at = 0
        while at < len(texts):
            # About four million characters at a time, so that new pieces are many and memory is bounded.
            found, fixed, chars = [], [], 0
            while at < len(texts) and (chars < 4_000_000 or not found):
                tokens, own = 0, []
                for stretch, is_added in self._stretches(texts[at]):
                    if is_added:
                        tokens += 1
                    else:
                        own.extend(self.pieces(stretch))
                found.append(own)
                fixed.append(tokens)
                chars += len(texts[at])
                at += 1
            wanted = set().union(*found)
            new = wanted.difference(self.counts)
            if len(self.counts) + len(new) > _REMEMBERED:
                self.counts.clear()
                new = wanted
            self._learn(list(new))
            count = self.counts.__getitem__
            out.extend(tokens + sum(map(count, own)) for tokens, own in zip(fixed, found, strict=True))
        return out

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of the text's prefixes of 0, 1, ... characters, each as if it stood alone.

        A prefix that ends inside an added token is encoded as the plain text it is.
        """
        out, tokens, plain = [np.zeros(1, np.int32)], 0, ""
        for stretch, is_added in self._stretches(text):
            # What stands before an added token is counted with it, as prefixes that end inside need it.
            plain = plain + stretch if is_added else stretch
            if is_added:
                out.pop()
            counts = self.prefixes_plain(plain)[1:] + tokens
            if is_added:
                before = len(plain) - len(stretch)
                tokens = (int(counts[before - 1]) if before else tokens) + 1
                counts[-1] = tokens
                plain = ""
            out.append(counts)
        return np.concatenate(out)

    def prefixes_plain(self, text: str) -> np.ndarray:
        """:meth:`prefixes` of a text without added tokens."""
        parts = self.pieces(text)
        counts = self.piece_counts([p.encode() for p in parts])
        out, tokens, at = np.zeros(len(text) + 1, np.int32), 0, 0
        blank_from, blank_tokens = None, 0  # where a run of blanks began, and the count before it
        for piece, found in zip(parts, counts, strict=True):
            ends = np.cumsum([len(c.encode()) for c in piece])
            out[at + 1 : at + len(piece) + 1] = tokens + found[ends]
            if piece in _CONTRACTIONS:  # cut after two characters, they are two pieces
                out[at + 2] = tokens + 2
            # Blanks at the end of a prefix are one piece, also the one that a word would take.
            blank = _BLANK.fullmatch(piece) is not None
            lead = len(piece) if blank else int(piece[0] == " ")
            if lead:
                if blank_from is None:
                    blank_from, blank_tokens = at, tokens
                if at > blank_from:
                    run = text[blank_from : at + lead]
                    sizes = np.cumsum([len(c.encode()) for c in run])
                    together = self.piece_counts([run.encode()])[0]
                    out[at + 1 : at + lead + 1] = blank_tokens + together[sizes[-lead:]]
            if not blank:
                blank_from = None
            tokens += int(found[-1])
            at += len(piece)
            out[at] = tokens if at == len(text) else out[at]
        return out


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text.

    A null or empty text has 0 bytes and 0 tokens. Ids may be null or repeat; rows are never merged.
    Other columns of ``docs`` are not read. ``path`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or PrefixCounter(path)
            texts = batch.column(1).fill_null("")
            sizes, tokens = np.diff(utf8(texts)[1]), counter.totals(texts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                names=[id_col, "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")


def prefix_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with ``prefix_tokens``: element i is the token count of the first i
    characters. Empty and null texts have the one element 0.

    ``prefix_tokens[n]`` answers "how many tokens has the text cut after n characters", and the last
    position with a value of at most B answers "how much fits into a budget of B tokens".
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or PrefixCounter(path)
            for row in range(batch.num_rows):
                counts = counter.prefixes(batch.column(1)[row].as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), pa.array([counts], pa.list_(pa.int32()))], names=[id_col, "prefix_tokens"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, prefix_tokens array<int>")
