"""BPE encoding and decoding by speculation and verification.

Words are encoded apart, so only distinct words of a batch are looked at. For each, greedy longest match proposes tokens. A proposal is
what merging by rank gives exactly when every token comes out of merging its own characters and every two neighbours are compatible: no
merge across their border comes before the merges that use up the pieces at the border. That test looks at the last pieces of the left
token and the first pieces of the right one over time, and runs over all new pairs of a batch at once. Only words that fail are merged.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .shared import give_back, importable, trimmed

#: A rank above all merges.
NEVER = 1 << 30
#: Distinct words whose encoding a worker keeps; beyond it, it starts anew.
CACHE_WORDS = 100_000
#: Characters of the texts that are looked at together.
BATCH_CHARS = 500_000
#: Symbols of the longest words that are merged together; longer ones are merged one by one.
TOGETHER = 64
#: Ends a word in the trie.
STOP = 256


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: itself where it is printable Latin-1, else the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Table:
    """A hash table from non-negative 64-bit integers to integers for whole arrays of keys, with open addressing."""

    def __init__(self, entries: dict[int, int]):
        self.bits = max(4, (3 * len(entries)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, dtype=np.int64), np.full(1 << self.bits, -1, dtype=np.int64)
        todo = np.array(list(entries.items()), dtype=np.int64).reshape(-1, 2)
        at = self.slot(todo[:, 0])
        while len(todo):
            free = self.keys[at] == -1
            first = np.zeros(len(todo), dtype=bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]], self.values[at[put]] = todo[put].T
            todo, at = todo[~put], (at[~put] + 1) & (len(self.keys) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for keys that aren't there."""
        at = self.slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], -1)
        left = np.flatnonzero((seen != keys) & (seen != -1))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[left]]
            hit = seen == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (seen != -1)]
        return out


class Merges:
    """Merge rules by token ids, with the pieces at either end of each token over the course of its merging."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.base = 1 + max(vocab.values(), default=0)
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        made, child = np.full(self.base, -1, dtype=np.int64), np.full((2, self.base), -1, dtype=np.int64)
        for r, (a, b) in enumerate(merges):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if (x, y) not in self.rank:
                self.rank[x, y] = (r, z)
                if made[z] < 0:
                    made[z], child[:, z] = r, (x, y)
        self.pairs = Table({x * self.base + y: r for (x, y), (r, _) in self.rank.items()})
        self.result = np.full(len(merges) + 1, -1, dtype=np.int64)
        for r, z in self.rank.values():
            self.result[r] = z
        #: By side (0: the first pieces, 1: the last ones): (piece, rank that makes it, rank that uses it up) from the token itself down.
        self.ends = []
        for side in (0, 1):
            levels, piece, used = [], np.arange(self.base), np.full(self.base, NEVER)
            while (piece >= 0).any():
                at = np.maximum(piece, 0)
                levels.append((piece, np.where(piece >= 0, made[at], NEVER), used))
                used, piece = np.where(piece >= 0, made[at], -1), np.where((piece >= 0) & (made[at] >= 0), child[side][at], -1)
            self.ends.append(levels)

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair of neighbouring tokens, whether merging leaves their border alone.

        A merge of rank r crosses the border if both pieces next to it are made before r and not used up by then; of equal pairs the
        leftmost goes first.
        """
        fine = np.ones(len(left), dtype=bool)
        for xs, x_made, x_used in self.ends[1]:
            some = np.flatnonzero(fine & (xs[left] >= 0))
            for ys, y_made, y_used in self.ends[0]:
                some = some[ys[right[some]] >= 0]
                if not len(some):
                    break
                a, b = left[some], right[some]
                r = self.pairs.get(xs[a] * self.base + ys[b])
                fine[some[(r > np.maximum(x_made[a], y_made[b])) & (r < x_used[a]) & (r <= y_used[b])]] = False
        return fine

    def merge(self, symbols: list[int]) -> list[int]:
        """Exact merging of one word: the pair of lowest rank, the leftmost of equal ones, again and again."""
        n = len(symbols)
        symbols, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(self.rank[p][0], i, *p) for i in range(n - 1) if (p := (symbols[i], symbols[i + 1])) in self.rank]
        heapq.heapify(queue)
        while queue:
            _, i, x, y = heapq.heappop(queue)
            j = after[i] if symbols[i] == x else n
            if j >= n or symbols[j] != y:
                continue
            symbols[i], symbols[j] = self.rank[x, y][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (p := (symbols[k], symbols[after[k]])) in self.rank:
                    heapq.heappush(queue, (self.rank[p][0], k, *p))
        return [s for s in symbols if s >= 0]

    def merge_all(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words at once, one merge of each word a round. word: the number of the word of each symbol, ascending."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = self._ranks(symbols, word)
        while len(symbols):
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, start)
            size = np.diff(np.r_[start, len(word)])
            open_ = np.repeat(least < NEVER, size)
            if not open_.all():
                done.append((symbols[~open_], word[~open_]))
                symbols, word, rank = symbols[open_], word[open_], rank[open_]
                least, size = least[least < NEVER], size[least < NEVER]
                if not len(symbols):
                    break
                start = np.r_[0, np.cumsum(size)[:-1]]
            hits = np.flatnonzero(rank == np.repeat(least, size))
            which = np.searchsorted(start, hits, "right")
            hits = hits[np.r_[True, which[1:] != which[:-1]]]
            symbols[hits] = self.result[rank[hits]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hits + 1] = False
            now = (np.cumsum(keep) - 1)[hits]
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            near = np.unique(np.r_[now, now[now > 0] - 1])
            rank[near] = self._ranks_at(symbols, word, near)
        if not done:
            return symbols, word
        symbols, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _ranks_at(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        after = np.minimum(at + 1, len(symbols) - 1)
        r = self.pairs.get(symbols[at] * self.base + symbols[after])
        return np.where((r >= 0) & (after > at) & (word[at] == word[after]), r, NEVER)

    def _ranks(self, symbols: np.ndarray, word: np.ndarray) -> np.ndarray:
        return self._ranks_at(symbols, word, np.arange(len(symbols)))


class WordBpe:
    """Encoder of a word-level BPE vocabulary file with word ends, lower case and byte-level characters."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = Merges(self.vocab, [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]])
        self.names = [""] * self.merges.base
        for name, i in self.vocab.items():
            self.names[i] = name
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.library = Tokenizer.from_file(path)
        # Texts of these characters are their own NFC form, and lower() and the word pattern agree with the library's on them.
        self.plain = regex.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ--İ]*+", regex.V1).fullmatch
        # The word pattern within those characters, lower-cased, white space made blanks.
        letter, number = "a-zªµºß-öø-ɏ", "0-9²³¹¼-¾"
        self.plain_words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^ {letter}{number}]+").findall
        self.alphabet = byte_alphabet()
        self.bytes = {c: b for b, c in enumerate(self.alphabet)}
        self.inner = np.array([self.vocab[c] for c in self.alphabet])
        self.final = np.array([self.vocab[c + self.end] for c in self.alphabet])
        self._grow()
        self.whole = self._reachable()
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}

    def _spelling(self, name: str) -> bytes | None:
        """The bytes of a token, and STOP's place by the end of the word; None for tokens that aren't spelt in bytes."""
        stem = name.removesuffix(self.end) if self.end and name != self.end else name
        return bytes(self.bytes[c] for c in stem) if all(c in self.bytes for c in stem) else None

    def _grow(self) -> None:
        """A trie of all tokens over bytes and STOP."""
        edges: dict[int, int] = {}
        token = [-1]
        for name, i in self.vocab.items():
            if (spelt := self._spelling(name)) is None:
                continue
            node = 0
            for b in [*spelt, STOP] if self.end and name.endswith(self.end) and name != self.end else spelt:
                after = edges.setdefault(node * 257 + b, len(token))
                if after == len(token):
                    token.append(-1)
                node = after
            token[node] = i
        self.edges, self.token = Table(edges), np.array(token)

    def _reachable(self) -> np.ndarray:
        """For each token, whether merging its own characters gives it back; some entries of a vocabulary can't be reached."""
        found = np.zeros(self.merges.base, dtype=bool)
        spelt = [(i, s, name.endswith(self.end)) for name, i in self.vocab.items() if (s := self._spelling(name)) and len(s) <= TOGETHER]
        sizes = np.array([len(s) for _, s, _ in spelt])
        data, ends = np.frombuffer(b"".join(s for _, s, _ in spelt), dtype=np.uint8), np.cumsum(sizes) - 1
        symbols = self.inner[data]
        closed = np.array([e for _, _, e in spelt])
        symbols[ends[closed]] = self.final[data[ends[closed]]]
        symbols, word = self.merges.merge_all(symbols, np.repeat(np.arange(len(spelt)), sizes))
        alone = np.bincount(word, minlength=len(spelt)) == 1
        ids = np.array([i for i, _, _ in spelt])
        first = np.searchsorted(word, np.arange(len(spelt)))
        same = alone & (symbols[first] == ids)
        found[ids[same]] = True
        return found

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens, as they are looked up: as characters where plain, else as byte-level characters after a NUL."""
        if self.plain(text):
            return self.plain_words(text.lower().replace("\n", " ").replace("\t", " ").replace("\r", " "))
        normal = self.library.normalizer.normalize_str(text)
        return ["\0" + w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def greedy(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest tokens from the left for all words at once: (tokens, numbers of their words), in order."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        word, at, turn = np.arange(len(start)), start.copy(), 0
        while len(word):
            node, here, best, to = np.zeros(len(word), dtype=np.int64), at.copy(), np.full(len(word), -1), at.copy()
            live = np.arange(len(word))
            while len(live):
                over = here[live] >= end[word[live]]
                step = np.where(over, STOP, data[np.minimum(here[live], len(data) - 1)])
                after = self.edges.get(node[live] * 257 + step)
                ok = after >= 0
                live, after, over = live[ok], after[ok], over[ok]
                node[live] = after
                here[live] += 1
                t = self.token[after]
                # An inner token can't take a word's last byte: that one carries the end.
                good = (t >= 0) & (over | (here[live] < end[word[live]]))
                best[live[good]], to[live[good]] = t[good], here[live[good]]
                live = live[~over]
            if (best < 0).any():
                raise ValueError("the vocabulary has no token for some byte")
            out.append((word, np.full(len(word), turn), best))
            more = to < end[word]
            word, at, turn = word[more], to[more], turn + 1
        word, turns, tokens = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((turns, word))
        return tokens[order], word[order]

    def learn(self, new: list[str]) -> None:
        """Encodes new words: proposals, the test of all new pairs at once, and merging of the words that fail."""
        if not new:
            return
        spelt = [bytes(map(self.bytes.__getitem__, w[1:])) if w[0] == "\0" else w.encode() for w in new]
        size = np.fromiter(map(len, spelt), dtype=np.int64, count=len(new))
        end = np.cumsum(size)
        start, data = end - size, np.frombuffer(b"".join(spelt), dtype=np.uint8).astype(np.int64)
        tokens, word = self.greedy(data, start, end)
        bad = np.zeros(len(new), dtype=bool)
        bad[word[~self.whole[tokens]]] = True
        border = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique(tokens[border] * self.merges.base + tokens[border + 1], return_inverse=True)
        fine = self.merges.compatible(pairs // self.merges.base, pairs % self.merges.base)
        bad[word[border[~fine[which]]]] = True
        if bad.any():
            of = np.repeat(np.arange(len(new)), size)
            symbols = self.inner[data]
            symbols[end - 1] = self.final[data[end - 1]]
            short = bad & (size <= TOGETHER)
            merged, owner = self.merges.merge_all(symbols[short[of]], of[short[of]])
            parts = [(tokens[~bad[word]], word[~bad[word]]), (merged, owner)]
            for i in np.flatnonzero(bad & ~short):
                one = np.array(self.merges.merge(symbols[start[i] : end[i]].tolist()))
                parts.append((one, np.full(len(one), i)))
            tokens, word = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(word, kind="stable")
            tokens, word = tokens[order], word[order]
        cut = np.searchsorted(word, np.arange(len(new) + 1)).tolist()
        raw, names = tokens.astype("<u4").tobytes(), [self.names[t] for t in tokens.tolist()]
        for i, w in enumerate(new):
            a, b = cut[i], cut[i + 1]
            self.ids[w], self.decoded[w] = raw[4 * a : 4 * b], " ".join(names[a:b])

    def segments(self, text: str) -> list[str]:
        return self.cut.split(text) if self.cut and "<|" in text else [text]

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """(ids as little-endian 32-bit integers, decoded text) of each text. What is kept of the texts at once has about BATCH_CHARS characters."""
        at = 0
        while at < len(texts):
            words, size = [], 0
            while at < len(texts) and size < BATCH_CHARS:
                parts = self.segments(texts[at])
                words.append(sum(([p] if p in self.special else self.split(p) for p in parts), []) if len(parts) > 1 else self.split(parts[0]))
                size += len(texts[at])
                at += 1
            if len(self.ids) > CACHE_WORDS:
                self.ids.clear()
                self.decoded.clear()
            new = set().union(*words).difference(self.ids)
            for name in new.intersection(self.special):
                self.ids[name], self.decoded[name] = array("I", [self.special[name]]).tobytes(), name
            self.learn(list(new.difference(self.special)))
            for found in words:
                yield b"".join(map(self.ids.__getitem__, found)), " ".join(map(self.decoded.__getitem__, found))


_LOADED: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """The vocabulary at path, loaded once in each Python process."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
        give_back()
    return _LOADED[path]


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row of docs: id, n_tokens long, ids_sha256, decoded_sha256; with ``with_ids`` also ids (array<int>) and decoded (string).

    A null text counts as empty: no tokens, the digests of nothing. Repeated rows give repeated rows, null ids stay null, an empty table
    gives an empty result, other columns are ignored. Special tokens written out in a text become the special tokens. No row leaves its
    task, so nothing is shuffled; a task holds one Arrow batch, its longest text and ``CACHE_WORDS`` words. path names a vocabulary file
    that every executor has.
    """
    importable(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n, a, b, ids, decoded = [], [], [], [], []
            for data, text in bpe.encode_batch(texts):
                n.append(len(data) // 4)
                a.append(hashlib.sha256(data).hexdigest())
                b.append(hashlib.sha256(text.encode()).hexdigest())
                if with_ids:
                    ids.append(np.frombuffer(data, dtype="<u4").astype(np.int32))
                    decoded.append(text)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(trimmed(run), schema).withColumnRenamed("id", id_col)


def decode_ids(ids: list[int], path: str) -> str:
    """The text that the ids stand for, special tokens kept: this vocabulary has no decoder, so tokens are joined by spaces."""
    bpe = encoder(path)
    special = {i: t for t, i in bpe.special.items()}
    return " ".join(special.get(i) or bpe.names[i] for i in ids)
