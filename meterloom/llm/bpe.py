"""Byte-pair encoding with a minimal acyclic transducer as lexicon, and decoding.

Frequent words are counted over the whole corpus (each task hands on its most frequent ones, counts are summed), encoded once by
exact merging, and compiled into a minimal acyclic automaton. Its transitions carry integer outputs whose sum along a word is the
word's index; the index leads to the word's ids. The automaton is one block of bytes, which each worker maps from an unlinked
temporary file. Words that the lexicon lacks are merged exactly, many at a time.

Nulls count as empty texts; an empty text has no ids. Rows that repeat are encoded like any other. Special tokens in a text are
encoded as their ids, as the public library does by default. Texts are taken whole: a long one is a block of its own. Of words that are
equally frequent the first in the alphabet enter the lexicon; which do changes no result. An empty table gives an empty one, and
columns beside id and text are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import struct
import tempfile
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, frugal, gathered, kept

#: Most words that the lexicon takes, and that each task hands on as candidates.
LEXICON_WORDS, TASK_WORDS = 60_000, 40_000
#: Characters of a pre-token; longer ones are merged with a heap instead of in batches.
LONG_WORD = 48
#: Pieces whose numbers of ids a task keeps when it only counts: some 20 MB; and those without a number that it holds at once.
COUNTED_PIECES, OPEN_PIECES = 200_000, 100_000
#: Characters of text that are encoded together.
BLOCK_CHARS = 1 << 23

_ODD_SPACE = regex.compile(r"[\x1c-\x1f]")


def _unknown() -> regex.Pattern:
    """Any one of the characters without a category."""
    runs: list[list[int]] = []
    for c in range(0x80, 0x110000):
        if unicodedata.category(chr(c)) == "Cn":
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return regex.compile("[" + "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in runs) + "]")


class Vocabulary:
    """A tokenizer file of the kind that marks word ends: vocabulary, merges, pattern and special tokens."""

    def __init__(self, spec: str):
        self.spec, self.unknown, self._public = spec, kept("unknown characters", _unknown), None
        d = json.loads(spec)
        model = d["model"]
        steps = [x["type"] for x in d["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or steps != ["NFC", "Replace", "Lowercase"] or d.get("decoder") is not None:
            raise ValueError("this kind of tokenizer file isn't supported")
        self.suffix = model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in d["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pattern = regex.compile(next(x for x in d["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")["pattern"]["Regex"])
        vocab = model["vocab"]
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for s, i in (vocab | self.special).items():
            self.tokens[i] = s
        # the visible character that stands for each byte: printable Latin-1 ones stand for themselves, the others follow from 256
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = iter(range(256, 512))
        chars = [chr(b) if b in shown else chr(next(spare)) for b in range(256)]
        self.byte_of = {c: b for b, c in enumerate(chars)}
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.final = np.array([vocab[c + self.suffix] for c in chars], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        # the same as an open-addressing table for vectorised look-ups
        keys = np.array([a << 32 | b for a, b in self.merges], np.uint64)
        values = np.array([r << 32 | i for r, i in self.merges.values()], np.int64)
        self.bits = 18
        self.keys = np.full(1 << self.bits, np.uint64((1 << 64) - 1))
        self.values = np.full(1 << self.bits, np.int64(1 << 62))
        self.tries = _fill(self.keys, self.values, keys, values, self.bits)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """rank << 32 | id of each pair's merge; 1 << 62 where there is none."""
        return _find(self.keys, self.values, a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64), self.bits, self.tries, 1 << 62)

    # -- exact merging --

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word (UTF-8): the lowest-ranked pair, the leftmost of these first, is merged until none is left."""
        counts, flat = self.merge_flat(words)
        ends = np.cumsum(counts).tolist()
        flat = flat.tolist()
        return [flat[e - n : e] for e, n in zip(ends, counts.tolist(), strict=True)]

    def merge_flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all words' ids one after the other)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        counts, done = np.zeros(len(words), np.int64), []
        for i in np.flatnonzero(sizes > LONG_WORD):
            ids = np.array([self.merge_long(words[i])], np.int32)
            counts[i] = ids.shape[1]
            done.append((np.array([i]), ids))
        order = np.argsort(sizes, kind="stable")
        order = order[(sizes[order] > 0) & (sizes[order] <= LONG_WORD)]
        for at in range(0, len(order), 4096):
            block = order[at : at + 4096]
            lens, raw = _matrix(words, sizes, block)
            width = raw.shape[1]
            ids = self.inner[raw]
            rows = np.arange(len(block))
            ids[rows, lens - 1] = self.final[raw[rows, lens - 1]]
            ids[np.arange(width)[None, :] >= lens[:, None]] = -1
            self._merge_block(ids, lens)
            counts[block] = lens
            done.append((block, ids[:, : int(lens.max())]))
        starts = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), np.int32)
        for block, ids in done:
            cols = np.arange(ids.shape[1])[None, :]
            has = cols < counts[block][:, None]
            flat[(starts[block][:, None] + cols)[has]] = ids[has]
        return counts, flat

    def _merge_block(self, ids: np.ndarray, lens: np.ndarray) -> None:
        none = np.int64(1 << 62)
        width = ids.shape[1]
        live = np.flatnonzero(lens > 1)
        cost = np.full((len(ids), max(width - 1, 1)), none)
        if len(live) and width > 1:
            cost[:, : width - 1] = np.where(ids[:, 1:] >= 0, self.look_up(ids[:, :-1], ids[:, 1:]), none)
        while len(live):
            c = cost[live]
            j = c.argmin(1)
            best = c[np.arange(len(live)), j]
            on = best < none
            live, j, best = live[on], j[on], best[on]
            if not len(live):
                return
            x = ids[live]
            n = lens[live]
            cols = np.arange(width)[None, :]
            src = np.minimum(cols + (cols > j[:, None]), width - 1)
            x = np.take_along_axis(x, src, 1)
            x[np.arange(len(live)), j] = (best & 0xFFFFFFFF).astype(np.int32)
            n = n - 1
            x[cols >= n[:, None]] = -1
            ids[live], lens[live] = x, n
            c = np.take_along_axis(cost[live], src[:, : width - 1].clip(max=width - 2), 1)
            c[cols[:, : width - 1] >= (n - 1)[:, None]] = none
            r = np.arange(len(live))
            for at, ok in ((j - 1, j > 0), (j, j < n - 1)):  # only the pairs beside the merge change
                rr, aa = r[ok], at[ok]
                c[rr, aa] = self.look_up(x[rr, aa], x[rr, aa + 1])
            cost[live] = c
            live = live[n > 1]

    def merge_long(self, word: bytes) -> list[int]:
        """The same for one word by a heap over a linked list: n log n for any length."""
        if not word:
            return []
        ids = [*self.inner[np.frombuffer(word, np.uint8)].tolist()]
        ids[-1] = int(self.final[word[-1]])
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := self.merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if m := self.merges.get((made, ids[after[i]])):
                    heapq.heappush(heap, (m[0], i, made, ids[after[i]], m[1]))
            if (p := before[i]) >= 0 and (m := self.merges.get((ids[p], made))):
                heapq.heappush(heap, (m[0], p, ids[p], made, m[1]))
        return [x for x in ids if x >= 0]

    # -- texts --

    def pieces(self, text: str) -> list[str]:
        """The text's white-space-free pieces after normalising, special tokens among them as they stand; no pre-token crosses a piece."""
        if self.special_split is not None and "<|" in text and self.special_split.search(text):
            out: list[str] = []
            for part in self.special_split.split(text):
                out += [part] if part in self.special else self.pieces(part)
            return out
        if not text.isascii():
            if self.is_new(text):
                return self.public().normalizer.normalize_str(text).split(" ")
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # lower-casing goes character by character, without the rule for a final sigma
        text = text.lower()
        return regex.split(r"[\t-\r \x85\xa0  -     　]+", text) if _ODD_SPACE.search(text) else text.split()

    def pre_tokens(self, piece: str) -> list[str]:
        if self.is_new(piece):
            return [bytes([self.byte_of[c] for c in x]).decode() for x, _ in self.public().pre_tokenizer.pre_tokenize_str(piece)]
        return self.pattern.findall(piece)

    def is_new(self, text: str) -> bool:
        """Whether a text has characters that this Python's tables don't know: versions of Unicode differ in them. For such texts alone
        the public library's own tables are asked what is a letter, and what its lower case."""
        if text.isascii():
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.unknown.search(text) is not None
        return False

    def public(self):
        if self._public is None:
            from tokenizers import Tokenizer

            self._public = Tokenizer.from_str(self.spec)
        return self._public

    def decode(self, ids) -> str:
        """The tokens' strings joined by spaces, as the public library does for a file without a decoder."""
        return " ".join([self.tokens[i] for i in ids])


def _matrix(words: list[bytes], sizes: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, bytes padded to the longest) of some of the words."""
    lens = sizes[block]
    width = int(lens.max())
    return lens.copy(), np.frombuffer(b"".join([words[i].ljust(width, b"\0") for i in block.tolist()]), np.uint8).reshape(len(block), width)


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _fill(table_keys, table_values, keys, values, bits) -> int:
    """Linear probing; the most steps that a look-up takes."""
    left, at, tries = np.arange(len(keys)), _slot(keys, bits), 0
    size = 1 << bits
    while len(left):
        tries += 1
        free = table_keys[at] == np.uint64((1 << 64) - 1)
        spot, first = np.unique(at[free], return_index=True)
        won = np.flatnonzero(free)[first]
        table_keys[spot], table_values[spot] = keys[left[won]], values[left[won]]
        stay = np.ones(len(left), bool)
        stay[won] = False
        left, at = left[stay], (at[stay] + 1) % size
    return tries


def _find(table_keys, table_values, keys, bits, tries, none) -> np.ndarray:
    shape = keys.shape
    keys = keys.ravel()
    out = np.full(len(keys), np.int64(none))
    at = _slot(keys, bits)
    got = table_keys[at]
    hit = got == keys
    out[hit] = table_values[at[hit]]
    left = np.flatnonzero(~hit & (got != np.uint64((1 << 64) - 1)))
    for _ in range(tries):
        if not len(left):
            break
        at[left] = (at[left] + 1) & ((1 << bits) - 1)
        got = table_keys[at[left]]
        hit = got == keys[left]
        out[left[hit]] = table_values[at[left[hit]]]
        left = left[~hit & (got != np.uint64((1 << 64) - 1))]
    return out.reshape(shape)


# -- the lexicon -------------------------------------------------------------------------------------------------------


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic automaton of the words (each with its ids) as one block of bytes.

    Words go in sorted order; when one leaves the path of the last, the states that are left are finished, the deepest first, and
    equal ones (same end mark, same transitions to finished states) become one. A state's count of words gives the outputs: a
    transition's output is the number of words that sort before those behind it, so the sum along a path is a word's index.
    """
    order = sorted(w for w in words if w)
    register: dict = {}
    finished: list[tuple[bool, tuple]] = []  # of each state: whether a word ends, (byte, state) in order
    path: list[list] = [[False, []]]
    last = b""

    def finish(depth: int) -> None:
        while len(path) > depth + 1:
            end, arcs = path.pop()
            key = (end, tuple(arcs))
            if key not in register:
                register[key] = len(finished)
                finished.append(key)
            path[-1][1].append((last[len(path) - 1], register[key]))

    for w in order:
        same = 0
        while same < min(len(w), len(last)) and w[same] == last[same]:
            same += 1
        finish(same)
        path.extend([False, []] for _ in w[same:])
        path[-1][0] = True
        last = w
    finish(0)
    finished.append((path[0][0], tuple(path[0][1])))
    below = np.zeros(len(finished), np.int64)
    keys, values = [], []
    for s, (end, arcs) in enumerate(finished):
        total = int(end)
        for byte, to in arcs:
            keys.append(s << 8 | byte)
            values.append(total << 32 | to)
            total += int(below[to])
        below[s] = total
    bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
    table_keys, table_values = np.full(1 << bits, np.uint64((1 << 64) - 1)), np.zeros(1 << bits, np.int64)
    tries = _fill(table_keys, table_values, np.array(keys, np.uint64), np.array(values, np.int64), bits)
    ends = np.array([e for e, _ in finished], np.uint8)
    starts = np.zeros(len(order) + 1, np.int64)
    np.cumsum([len(words[w]) for w in order], out=starts[1:])
    ids = np.array([i for w in order for i in words[w]], np.int32)
    head = struct.pack("<6q", len(finished), bits, tries, len(order), len(ids), 0)
    return head + table_keys.tobytes() + table_values.tobytes() + starts.tobytes() + ids.tobytes() + ends.tobytes()


class Lexicon:
    """A compiled lexicon over a buffer, such as a mapped file."""

    def __init__(self, buffer):
        self.states, self.bits, self.tries, self.words, n_ids, _ = struct.unpack_from("<6q", buffer, 0)
        at, size = 48, 1 << self.bits

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(buffer, kind, n, at)
            at += out.nbytes
            return out

        self.keys, self.values = take(np.uint64, size), take(np.int64, size)
        self.starts, self.ids, self.ends = take(np.int64, self.words + 1), take(np.int32, n_ids), take(np.uint8, self.states)

    @classmethod
    def mapped(cls, block: bytes) -> Lexicon:
        f = tempfile.TemporaryFile()
        f.write(block)
        f.flush()
        return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def indices(self, words: list[bytes]) -> np.ndarray:
        """Each word's index, or -1: all words walk the automaton together, a byte at a time."""
        out = np.full(len(words), -1, np.int64)
        if not self.words:
            return out
        lens = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lens, kind="stable")
        for at in range(0, len(order), 8192):
            block = order[at : at + 8192]
            block = block[(lens[block] > 0) & (lens[block] <= 4 * LONG_WORD)]
            if not len(block):
                continue
            n, raw = _matrix(words, lens, block)
            width = raw.shape[1]
            state, total, live = np.full(len(block), self.states - 1, np.int64), np.zeros(len(block), np.int64), np.arange(len(block))
            for j in range(width):
                live = live[n[live] > j]
                got = _find(self.keys, self.values, state[live].astype(np.uint64) << np.uint64(8) | raw[live, j].astype(np.uint64), self.bits, self.tries, -1)
                state[live] = np.where(got < 0, -1, got & 0xFFFFFFFF)
                total[live] += np.where(got < 0, 0, got >> 32)
                live = live[got >= 0]
            found = (state >= 0) & (self.ends[state] > 0)
            out[block[found]] = total[found]
        return out

    def ids_at(self, i: int) -> list[int]:
        return self.ids[self.starts[i] : self.starts[i + 1]].tolist()


class Encoder:
    """Encodes blocks of texts by way of a lexicon: each distinct piece of a block is encoded once, and texts are put together from
    the pieces' results, all in arrays."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.v, self.lexicon = vocabulary, lexicon
        self.numerals = pa.array([str(i) for i in range(len(vocabulary.tokens))])
        self.tokens = pa.array(vocabulary.tokens)

    def distinct(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all pieces' ids): pre-tokens by the lexicon, those that it lacks by exact merging."""
        special = self.v.special
        split = [(p,) if p.isalpha() or p in special else self.v.pre_tokens(p) for p in pieces]  # letters alone are one pre-token
        index = dict.fromkeys([w for x in split for w in x])
        words = list(index)
        index = dict(zip(words, range(len(words)), strict=True))
        raw = [w.encode() for w in words]
        at = self.lexicon.indices(raw)
        for w, i in special.items():
            if w in index:
                at[index[w]] = -2 - i
        lacking = np.flatnonzero(at == -1)
        counts = np.ones(len(words), np.int64)
        known = np.flatnonzero(at >= 0)
        counts[known] = self.lexicon.starts[at[known] + 1] - self.lexicon.starts[at[known]]
        new_counts, new = self.v.merge_flat([raw[i] for i in lacking.tolist()])
        counts[lacking] = new_counts
        starts = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), np.int32)
        flat[_ranges(starts[known], counts[known])] = self.lexicon.ids[_ranges(self.lexicon.starts[at[known]], counts[known])]
        flat[_ranges(starts[lacking], new_counts)] = new
        marks = np.flatnonzero(at < -1)
        flat[starts[marks]] = -2 - at[marks]
        codes = np.array([index[w] for x in split for w in x], np.int64)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.concatenate([[0], np.cumsum(counts[codes])])
        word_ends = np.cumsum(sizes)
        return ends[word_ends] - ends[word_ends - sizes], flat[_ranges(starts[codes], counts[codes])]

    def blocks(self, texts: list[str], with_ids: bool = False, most: int = BLOCK_CHARS):
        """(number of ids, ids as text, decoded ids, ids on request) of runs of texts."""
        at = 0
        while at < len(texts):
            pieces, sizes, size = [], [], 0
            while at < len(texts) and (not sizes or size < most):
                x = self.v.pieces(texts[at])
                pieces += x
                sizes.append(len(x))
                size += len(texts[at])
                at += 1
            coded = pa.array(pieces, pa.string()).dictionary_encode()
            del pieces
            codes = coded.indices.to_numpy(zero_copy_only=False)
            counts, flat = self.distinct(coded.dictionary.to_pylist())
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            shown = [pc.binary_join(pa.ListArray.from_arrays(offsets, x.take(pa.array(flat))), " ") for x in (self.numerals, self.tokens)]
            # a piece without ids leaves no gap
            keep = counts[codes] > 0
            ends = np.cumsum(np.array(sizes, np.int64))
            kept_before = np.concatenate([[0], np.cumsum(keep)])
            codes = codes[keep]
            bounds = np.concatenate([[0], kept_before[ends]])
            lists = pa.array(bounds.astype(np.int64))
            wide = [x.cast(pa.large_string()).take(pa.array(codes)) for x in shown]
            ids_text, decoded = (pc.binary_join(pa.LargeListArray.from_arrays(lists, x), pa.scalar(" ", pa.large_string())) for x in wide)
            total = np.concatenate([[0], np.cumsum(counts[codes])])[bounds]
            ids = None
            if with_ids:
                starts = np.cumsum(counts) - counts
                all_ids = flat[_ranges(starts[codes], counts[codes])]
                ids = [all_ids[a:b].tolist() for a, b in zip(total[:-1].tolist(), total[1:].tolist(), strict=True)]
            yield np.diff(total), ids_text, decoded, ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x for block in self.blocks(texts, True) for x in block[3]]


class TokenCounter:
    """Numbers of ids without the ids: each distinct piece is merged exactly once and its number kept, so no lexicon is needed and texts are
    read once. Kept numbers only spare work; when there are too many of them those go that weren't met for longest, and are made again when
    met."""

    def __init__(self, vocabulary: Vocabulary, most: int = COUNTED_PIECES):
        self.v, self.most = vocabulary, most
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def distinct(self, pieces: list[str]) -> dict[str, int]:
        """The number of ids of each of the pieces, none of which is among those known."""
        found = {p: self.older[p] for p in pieces if p in self.older}
        lacking = [p for p in pieces if p not in found]
        special = self.v.special
        split = [() if p in special else (p,) if p.isalpha() else self.v.pre_tokens(p) for p in lacking]
        words = list(dict.fromkeys([w for x in split for w in x]))
        sizes, _ = self.v.merge_flat([w.encode() for w in words])
        size_of = dict(zip(words, sizes.tolist(), strict=True))
        found.update((p, 1 if p in special else sum([size_of[w] for w in x])) for p, x in zip(lacking, split, strict=True))
        self.known.update(x for x in found.items() if len(x[0]) <= LONG_WORD)
        if len(self.known) > self.most // 2:
            self.known, self.older = {}, self.known if len(self.known) <= 2 * self.most else {}  # one text may have any number
        return found

    def counts(self, texts: list[str], most: int = OPEN_PIECES):
        """Numbers of ids of runs of texts. A text's pieces go as soon as it is read, but for those without a known number: when there are
        so many of them, theirs are made and the run ends."""
        totals, lacking = [], []
        waiting = 0
        for i, text in enumerate(texts):
            pieces = self.v.pieces(text)
            got = [*map(self.known.get, pieces)]
            totals.append(sum(filter(None, got)))
            lacking.append([p for p, n in zip(pieces, got, strict=True) if n is None] if None in got else [])
            waiting += len(lacking[-1])
            if waiting >= most or i == len(texts) - 1:
                found = self.distinct(list(dict.fromkeys([p for x in lacking for p in x])))
                yield np.array([n + sum(map(found.__getitem__, x)) for n, x in zip(totals, lacking, strict=True)], np.int64)
                totals, lacking, waiting = [], [], 0


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then from starts[1]."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def sha256_each(texts: pa.Array) -> list[str]:
    """Of each text's UTF-8 bytes, as lowercase hexadecimal digits."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1 + texts.offset)[texts.offset :].tolist()
    data = memoryview(texts.buffers()[2] or b"")
    return [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offsets, offsets[1:], strict=False)]


# -- on Spark ----------------------------------------------------------------------------------------------------------


def _texts(column) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def frequent_words(docs: DataFrame, vocabulary_bytes, text: str, most: int = LEXICON_WORDS, per_task: int = TASK_WORDS) -> DataFrame:
    """(word, n): the most frequent pre-tokens. Counts cover all texts; a word counts in each task where it is among the task's `per_task` first."""

    def count(batches):
        v = Vocabulary(vocabulary_bytes.value)
        seen: Counter = Counter()
        for b in batches:
            held: list[str] = []
            texts = _texts(b.column(0))
            for i, t in enumerate(texts):
                held += v.pieces(t)
                if len(held) > 1_000_000 or i == len(texts) - 1:
                    found = pa.array(held, pa.string()).value_counts()
                    for p, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True):
                        seen[p] += n
                    held = []
                    if len(seen) > 20 * per_task:  # the task's memory stays bounded: the rarest go
                        seen = Counter(dict(most_frequent(seen, 10 * per_task)))
        words: Counter = Counter()
        for p, n in most_frequent(seen, 2 * per_task):
            if p not in v.special:
                for w in v.pre_tokens(p):
                    words[w] += n
        top = most_frequent(words, per_task)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["word", "n"])

    def most_frequent(counter, k):
        if len(counter) <= k:
            return list(counter.items())
        cut = int(np.partition(np.fromiter(counter.values(), np.int64, len(counter)), -k)[-k])
        return [x for x in counter.items() if x[1] > cut] or [x for x in counter.items() if x[1] == cut][:k]

    parts = docs.select(F.col(text).alias("t")).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)


def _shared(docs: DataFrame, vocabulary_path: str, text: str) -> tuple:
    """The vocabulary and the lexicon of the texts' frequent words, as broadcasts."""
    batch_rows(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    with open(vocabulary_path, encoding="utf-8") as f:
        spec = f.read()
    shared_spec = sc.broadcast(spec)
    v = Vocabulary(spec)
    words = [r[0].encode() for r in frequent_words(docs, shared_spec, text).collect()]  # at most LEXICON_WORDS
    return shared_spec, sc.broadcast(compile_lexicon(dict(zip(words, v.merge_many(words), strict=True))))


def token_counts(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n: how many ids each text has. The vocabulary goes with the task, so later stages don't find it in their workers' memory."""
    batch_rows(docs.sparkSession)
    with open(vocabulary_path, encoding="utf-8") as f:
        shared_spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        counter = TokenCounter(Vocabulary(shared_spec.value))
        for b in batches:
            counts = [x for y in counter.counts(_texts(b.column(1))) for x in y.tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64())], names=[id_column, "n"])

    return docs.select(id_column, text).mapInArrow(frugal(run), f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}, n long")


def encode_decode(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per document: id, n_tokens, ids_sha256, decoded_sha256 and, on request, ids and decoded text."""
    shared_spec, block = _shared(docs, vocabulary_path, text)

    def run(batches):
        enc = worker_encoder(shared_spec, block)
        for b in gathered(batches):  # enough for blocks in which words repeat
            at = 0
            for n, ids_text, decoded, ids in enc.blocks(_texts(b.column(1)), keep_ids):
                cols = [b.column(0).slice(at, len(n)), pa.array(n, pa.int64()), pa.array(sha256_each(ids_text), pa.string()), pa.array(sha256_each(decoded), pa.string())]
                names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols += [pa.array(ids, pa.list_(pa.int32())), decoded.cast(pa.string())]
                    names += ["ids", "decoded"]
                at += len(n)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[id_column].dataType.simpleString()
    out = f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if keep_ids else "")
    return docs.select(id_column, text).mapInArrow(run, out)


def worker_encoder(spec, block) -> Encoder:
    """One encoder for all of a worker's tasks with the same broadcasts."""
    return kept(("encoder", hash(spec.value), hash(block.value)), lambda: Encoder(Vocabulary(spec.value), Lexicon.mapped(block.value)))
