"""BPE encoding and decoding by speculation and verification.

For all distinct words of a block of texts one greedy longest match (an
Aho-Corasick automaton over the vocabulary) proposes tokens.  A proposal is the exact BPE result if each adjacent pair of tokens
is *compatible*: encoding the two tokens' joined text gives back these two.
All distinct pairs of a batch are tested together with array operations that
walk both tokens' merge trees towards their common border.  Only words with a
failing pair, or an end that the greedy match can't place, are merged exactly
in rank order, many words at a time.

A block's texts are cut into words over their bytes, and words become numbers
once a block: ids and decoded texts are then taken by number, so Python objects
are made for a block's distinct words only.

The vocabulary file (``tokenizers`` JSON, BPE with an end-of-word suffix,
byte-level alphabet) is a parameter; its normaliser and word pattern are read
from it.  The parts supported are those of such files: NFC, a pattern replaced
by a string, lower case; a removed-inverted split; added tokens that are not
normalised; white space parts words.  Anything else raises ``ValueError``.
Letters and digits are those of the ``regex`` module's Unicode tables; a library built
on older tables splits words with characters added since then differently.

Defined results: null text is encoded as the empty text (no ids, empty decoded
text).  Ids, repeats and other columns don't matter; each row stands alone.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

CACHE_WORDS = 1 << 18      # distinct words remembered per Python worker
END = "\0"                 # stands for the end-of-word suffix in match strings
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2028\u2029\u202f\u205f\u3000"
ALL_WHITE = regex.compile(r"\s+")
KINDS = [regex.compile(p) for p in (r"\s", r"\p{L}", r"\p{N}")]     # 0 to 2; 3: any other character
KIND_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"     # the pattern whose words are found by these kinds
ADDED = b"\xff"            # so many stand for an added token among bytes of texts
NEVER = np.int64(1) << 41  # above all ranks


def byte_alphabet() -> list[str]:
    """The public byte-level alphabet: printable Latin-1 bytes as themselves, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class Bpe:
    """Tables of one vocabulary file; made once per Python worker."""

    def __init__(self, spec: str):
        config = json.loads(spec)
        model = config["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or not self.suffix or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("only plain BPE with an end-of-word suffix is supported")
        self.vocab: dict[str, int] = model["vocab"]
        self.text = {i: t for t, i in self.vocab.items()}
        size = max(self.vocab.values()) + 1
        self.left = np.full(size, -1, dtype=np.int64)
        self.right = np.full(size, -1, dtype=np.int64)
        self.rank = np.full(size, -1, dtype=np.int64)      # of the merge that makes the token
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b, made = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.merges[a, b] = rank, made
            if self.rank[made] < 0:
                self.left[made], self.right[made], self.rank[made] = a, b, rank
        keys = np.array([a << 32 | b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_ranks, self.key_made = np.array(list(self.merges.values()), dtype=np.int64)[order].T.copy()
        self.normalise = self._normaliser(config["normalizer"])
        pattern = self._word_pattern(config["pre_tokenizer"])
        self.split: Callable[[str], list[str]] = pattern.findall
        self.words = self.words_by_kind if pattern.pattern == KIND_WORDS else self.words_by_pattern
        self.alphabet = byte_alphabet()
        added = config.get("added_tokens") or []
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("only plain added tokens are supported")
        self.added = {t["content"]: t["id"] for t in added}
        self.added_keys = {t: ADDED * n for n, t in enumerate(self.added, 1)}
        self.added_pattern = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if added else None
        if any(set(WHITE) & set(piece) for w in WHITE for piece in self.split(f"a{w}1{w}!{w}'s{w}é")):
            raise ValueError("a word of this pre-tokenizer can hold white space")
        self.latin = str.maketrans({b: c for b, c in enumerate(self.alphabet)})
        self.by_byte = np.array(list(map(ord, self.alphabet)), dtype="<u4")
        self.by_byte[ord("\n")] = ord("\n")                 # parts words
        # kinds of code points, as far as known; of the bytes of ASCII, and that of ``ADDED``
        self.kinds = np.full(0x110000, 255, dtype=np.uint8)
        self.byte_kinds = np.full(256, 4, dtype=np.uint8)
        self.byte_kinds[:128] = self.kinds_of(np.arange(128))
        self.automaton = ahocorasick.Automaton()
        for token, i in self.vocab.items():
            if token != self.suffix:
                self.automaton.add_word(self._match_form(token), i)
        self.automaton.make_automaton()
        # of one symbol, within a word and at its end
        # the last place stands for all characters beyond
        beyond = 1 + max([ord(t) for t in map(self._bare, self.vocab) if len(t) == 1], default=0)
        self.symbol_ids = np.array([*(self.vocab.get(chr(c), -1) for c in range(beyond)), -1], dtype=np.int64)
        self.end_ids = np.array([*(self.vocab.get(chr(c) + self.suffix, -1) for c in range(beyond)), -1], dtype=np.int64)
        # of each id, with the space behind it
        names = self.text | {i: t for t, i in self.added.items()}
        self.names = pa.array([f"{names.get(i, '')} ".encode() for i in range(max(names) + 1)], type=pa.large_binary())
        self.forget()
        self.sound = np.full(size, -1, dtype=np.int8)      # not known yet
        self.merged_words = 0

    @staticmethod
    def _normaliser(config: dict) -> Callable[[str], str]:
        steps = []
        for part in config["normalizers"] if config["type"] == "Sequence" else [config]:
            if part["type"] == "NFC":
                steps.append(lambda s: s if s.isascii() else unicodedata.normalize("NFC", s))
            elif part["type"] == "Replace" and "Regex" in part["pattern"]:
                if part["pattern"]["Regex"] != r"\s+" or part["content"] != " ":
                    raise ValueError("only white space can be replaced")   # which parts words in either form
            elif part["type"] == "Lowercase":
                # per character, without the word-final form that str.lower() gives to sigma
                steps.append(lambda s: s.lower() if "Σ" not in s else "σ".join(x.lower() for x in s.split("Σ")))
            else:
                raise ValueError(f"normaliser {part['type']} is not supported")

        def run(text: str) -> str:
            for step in steps:
                text = step(text)
            return text
        return run

    @staticmethod
    def _word_pattern(config: dict) -> regex.Pattern:
        parts = config["pretokenizers"] if config["type"] == "Sequence" else [config]
        split = parts[0]
        if len(parts) != 2 or split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"] \
                or parts[1]["type"] != "ByteLevel" or parts[1]["use_regex"] or parts[1]["add_prefix_space"]:
            raise ValueError("this pre-tokenizer is not supported")
        return regex.compile(split["pattern"]["Regex"])

    def forget(self) -> None:
        """Only the added tokens are remembered: each word's row, and where its tokens stop."""
        self.rows: dict[bytes, int] = {key: n for n, key in enumerate(self.added_keys.values())}
        self.tokens = np.array(list(self.added.values()), dtype="<u4")
        self.stops = np.arange(len(self.added) + 1)

    # -- speculation ---------------------------------------------------------

    def _bare(self, token: str) -> str:
        return token.removesuffix(self.suffix)

    def _match_form(self, token: str) -> str:
        return token.removesuffix(self.suffix) + END if token.endswith(self.suffix) else token

    def symbols(self, word: str) -> str:
        return word.encode("utf-8").decode("latin-1").translate(self.latin)

    def all_symbols(self, words: list[str]) -> list[str]:
        joined = np.frombuffer("\n".join(words).encode(), dtype=np.uint8)
        return self.by_byte[joined].tobytes().decode("utf-32-le").split("\n") if words else []

    def propose(self, symbols: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy longest match of all words: tokens, their word, and which words are covered to their end."""
        line = END.join(symbols) + END
        found = np.fromiter(chain.from_iterable(self.automaton.iter_long(line)), dtype=np.int64).reshape(-1, 2)
        stops = np.cumsum(np.fromiter(map(len, symbols), dtype=np.int64, count=len(symbols)) + 1) - 1
        word = np.searchsorted(stops, found[:, 0])
        covered = np.zeros(len(symbols), dtype=bool)
        covered[word[found[:, 0] == stops[word]]] = True
        return found[:, 1], word, covered

    # -- verification --------------------------------------------------------

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of merging a and b, or ``NEVER``."""
        key = np.where((a < 0) | (b < 0), -1, a << 32 | b)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens: does their joined text encode to exactly them?

        A merge across the border happens if, at some moment of building both
        tokens, the two symbols at the border can merge before the next merge
        inside either side.  The moments are walked backwards: the side whose
        last merge is later is taken apart, until both are base symbols.
        """
        ok = np.ones(len(a), dtype=bool)
        limit = np.full(len(a), NEVER)                      # rank of the merge that ends this moment
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        while len(live):
            x, y = a[live], b[live]
            crossing = self._merge_rank(x, y)
            ra, rb = self.rank[x], self.rank[y]
            # on equal ranks the left one merges first, so the right one is undone first
            undo_left = ra > rb
            last = np.maximum(ra, rb)                      # made at this rank, so the moment starts behind it
            # x and y are neighbours until `limit`; a crossing merge of lower rank comes first
            breaks = crossing < limit[live]
            ok[live[breaks]] = False
            go = ~breaks & (last >= 0)
            live, undo_left, last, x, y = live[go], undo_left[go], last[go], x[go], y[go]
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
            # a crossing merge of the same rank wins only if it stands left of the one undone
            limit[live] = np.where(undo_left, last, last + 1)
        return ok

    def merge_exactly(self, words: list[str], ends: bool = True) -> list[list[int]]:
        """Exact BPE of many symbol strings at once; ``ends``: do the strings end a word?"""
        out: list[list[int]] = [[] for _ in words]
        order, flat, lengths = self._merged(words, ends)
        stops, flat = np.cumsum(lengths).tolist(), flat.tolist()
        for i, a, b in zip(order, [0, *stops], stops):
            out[i] = flat[a:b]
        return out

    def _merged(self, words: list[str], ends: bool = True) -> tuple[list[int], np.ndarray, np.ndarray]:
        """The order in which the words were merged, those of like length together, all their tokens and how many each has.

        In each round every word merges its pair of lowest rank, leftmost
        first, until none has a pair left.
        """
        lengths = list(map(len, words))
        order = sorted(range(len(words)), key=lengths.__getitem__)
        at = 0
        flat, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        while at < len(order):
            n = lengths[order[at]]
            stop = at + 1
            while stop < len(order) and stop - at < 4096 and lengths[order[stop]] <= n + 2 and (stop - at) * (n + 2) < 1 << 20:
                stop += 1
            made = self._merge_block(self._symbol_ids([words[i] for i in order[at:stop]], ends))
            real = made >= 0
            flat.append(made[real])
            counts.append(real.sum(axis=1))
            at = stop
        return order, np.concatenate(flat), np.concatenate(counts)

    def _symbol_ids(self, words: list[str], ends: bool) -> np.ndarray:
        """A row per word: its symbols' ids from the left, -1 behind; symbols that the vocabulary lacks are left out."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        chars = np.minimum(np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4"), len(self.symbol_ids) - 1)
        ids = self.symbol_ids[chars]
        if ends:
            last = (np.cumsum(lengths) - 1)[lengths > 0]
            ids[last] = self.end_ids[chars[last]]
        known = ids >= 0
        row = np.repeat(np.arange(len(words)), lengths)[known]
        kept = np.bincount(row, minlength=len(words))
        tokens = np.full((len(words), max(2, kept.max(initial=0))), -1, dtype=np.int64)
        tokens[row, np.arange(len(row)) - np.repeat(np.cumsum(kept) - kept, kept)] = ids[known]
        if ends and self.suffix in self.vocab:
            tokens[lengths == 0, 0] = self.vocab[self.suffix]
        return tokens

    def _merge_block(self, tokens: np.ndarray) -> np.ndarray:
        width = tokens.shape[1]
        ranks = self._merge_rank(tokens[:, :-1], tokens[:, 1:])
        done = np.full_like(tokens, -1)
        index = np.arange(len(tokens))
        while len(index):
            best = ranks.argmin(axis=1)
            rows = np.arange(len(index))
            going = ranks[rows, best] < NEVER
            done[index[~going]] = tokens[~going]
            tokens, ranks, index, best = tokens[going], ranks[going], index[going], best[going]
            rows = rows[:len(index)]
            if not len(index):
                break
            made = self.key_made[np.searchsorted(self.keys, tokens[rows, best] << 32 | tokens[rows, best + 1])]
            # close the gap behind the merged pair
            place = np.arange(width - 1)
            moved = np.take_along_axis(tokens, np.minimum(place + (place > best[:, None]), width - 1), axis=1)
            tokens = np.concatenate([moved, np.full((len(index), 1), -1)], axis=1)
            tokens[rows, best] = made
            place = np.arange(width - 2)
            moved = np.take_along_axis(ranks, np.minimum(place + (place >= best[:, None]), width - 2), axis=1)
            ranks = np.concatenate([moved, np.full((len(index), 1), NEVER)], axis=1)
            ranks[rows, best] = self._merge_rank(made, tokens[rows, best + 1])
            before = np.maximum(best - 1, 0)
            ranks[rows, before] = np.where(best > 0, self._merge_rank(tokens[rows, before], made), ranks[rows, before])
        return done

    def reachable(self, tokens: np.ndarray) -> np.ndarray:
        """Does each token's own text encode to it? (A few of a vocabulary may be out of reach.)"""
        new = np.unique(tokens[self.sound[tokens] < 0])
        for ends in (False, True):
            part = [t for t in new.tolist() if self.text[t].endswith(self.suffix) == ends]
            texts = [self.text[t].removesuffix(self.suffix) for t in part]
            for t, got in zip(part, self.merge_exactly(texts, ends)):
                self.sound[t] = got == [t]
        return self.sound[tokens] > 0

    def encode_words(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The words in another order, all their tokens and how many each has."""
        symbols = self.all_symbols(words)
        tokens, word, good = self.propose(symbols)
        good[word[~self.reachable(tokens)]] = False
        inner = word[:-1] == word[1:]
        pairs, which = np.unique(tokens[:-1][inner] << 32 | tokens[1:][inner], return_inverse=True)
        fits = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
        good[word[:-1][inner][~fits[which]]] = False
        failed = np.flatnonzero(~good).tolist()
        order, exact, counts = self._merged([symbols[i] for i in failed])
        self.merged_words += len(failed)
        return ([words[i] for i in np.flatnonzero(good).tolist()] + [words[failed[i]] for i in order],
                np.concatenate([tokens[good[word]], exact]), np.concatenate([np.bincount(word, minlength=len(words))[good], counts]))

    def learn(self, new: list[bytes]) -> None:
        """Encode words not yet known and remember them."""
        words, tokens, counts = self.encode_words(b"\n".join(new).decode().split("\n"))
        rows = range(len(self.stops) - 1, len(self.stops) - 1 + len(words))
        self.tokens = np.concatenate([self.tokens, tokens.astype("<u4")])
        self.stops = np.concatenate([self.stops, self.stops[-1] + np.cumsum(counts)])
        self.rows.update(zip("\n".join(words).encode().split(b"\n"), rows))

    # -- whole texts ---------------------------------------------------------

    def parts(self, text: str) -> list[bytes]:
        """The normalised text, parted by the keys of its added tokens."""
        if not any(t in text for t in self.added):
            return [self.normalise(text).encode()]
        out, at = [], 0
        for found in self.added_pattern.finditer(text):
            out += self.normalise(text[at:found.start()]).encode(), self.added_keys[found[0]]
            at = found.end()
        return [*out, self.normalise(text[at:]).encode()]

    def kinds_of(self, codes: np.ndarray) -> np.ndarray:
        for c in np.unique(codes[self.kinds[codes] == 255]).tolist():
            self.kinds[c] = next((k for k, p in enumerate(KINDS) if p.match(chr(c))), len(KINDS))
        return self.kinds[codes]

    def words_by_kind(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """All words, and where each text's words begin and end.

        A word is a run of bytes of one kind, but a digit stands alone, and an apostrophe alone before one of the pattern's endings is
        one word with that ending.
        """
        parts = [b"\n".join(self.parts(t)) for t in texts]
        raw = np.frombuffer(b"\n".join(parts) + b"\n\n\n", dtype=np.uint8)
        kind = self.byte_kinds[raw]
        lead = np.flatnonzero((raw >= 0xC0) & (raw < ADDED[0]))
        inner = np.zeros(0, dtype=np.int64)
        if len(lead):
            width = 2 + (raw[lead] >= 0xE0) + (raw[lead] >= 0xF0)
            code = raw[lead].astype(np.int64) & 0x7F >> width
            rest = [(n, width > n) for n in (1, 2, 3)]
            for n, has in rest:
                code[has] = code[has] << 6 | raw[lead[has] + n] & 0x3F
            kind[lead] = kinds = self.kinds_of(code)
            for n, has in rest:
                kind[lead[has] + n] = kinds[has]
            inner = np.concatenate([lead[has] + n for n, has in rest])
        start = kind == 2
        start[1:] |= kind[1:] != kind[:-1]
        start[0] = True
        start[inner] = False
        mark = np.flatnonzero(raw == ord("'"))
        mark = mark[start[mark]]
        one, two = raw[mark + 1], raw[mark + 2]
        short = np.isin(one, list(b"stmd"))
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        start[mark[short | long] + 1] = False
        start[np.concatenate([mark[short] + 2, mark[long] + 3])] = True
        kept = kind != 0
        start &= kept
        words = _binary(np.append(np.flatnonzero(start[kept]), np.count_nonzero(kept)), raw[kept])
        begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
        return words, np.searchsorted(np.flatnonzero(start), begins)

    def words_by_pattern(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """As ``words_by_kind``, for any pattern, word by word."""
        words, stops = [], [0]
        for text in texts:
            for part in self.parts(text):
                if part.startswith(ADDED):
                    words.append(part)
                else:
                    words += [w.encode() for piece in ALL_WHITE.split(part.decode()) for w in self.split(piece)]
            stops.append(len(words))
        return pa.array(words, type=pa.large_binary()), np.array(stops)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, memoryview, np.ndarray]:
        """The ids of all texts as little-endian uint32 and where each text's begin and end; the same of the decoded texts' bytes.

        Without a decoder in the file, decoding joins the tokens' own strings by spaces. One space follows each decoded text that
        isn't empty.
        """
        words, bounds = self.words(texts)
        numbered = words.dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        if len(self.rows) > CACHE_WORDS:
            self.forget()
        new = [w for w in distinct if w not in self.rows]
        if new:
            self.learn(new)
        row = np.fromiter(map(self.rows.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        counts = self.stops[row + 1] - self.stops[row]
        ends = np.cumsum(np.append(0, counts))
        tokens = self.tokens[np.arange(ends[-1]) + np.repeat(self.stops[row] - ends[:-1], counts)]
        stops, names = _buffers(self.names.take(pa.array(tokens)))
        id_stops, ids = _buffers(_binary(4 * ends, tokens).take(numbered.indices))
        text_stops, text = _buffers(_binary(stops[ends], names).take(numbered.indices))
        return np.frombuffer(ids, dtype="<u4"), id_stops[bounds] // 4, text, text_stops[bounds]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.names.take(pa.array(ids)).to_pylist())[:-1].decode()


def _binary(stops: np.ndarray, data: np.ndarray | memoryview) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops) - 1, [None, pa.py_buffer(stops.astype(np.int64)), pa.py_buffer(data)])


def _buffers(array: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Of binary values: where they begin and end, and all their bytes."""
    if not len(array):
        return np.zeros(1, dtype=np.int64), memoryview(b"")
    _, stops, data = array.buffers()
    stops = np.frombuffer(stops, dtype=np.int64)[array.offset:array.offset + len(array) + 1]
    return stops, memoryview(data or b"")[:stops[-1]]


@lru_cache(maxsize=1)
def _tables(spec: str) -> Bpe:
    """Workers keep the tables and the words learnt for the tasks to come."""
    return Bpe(spec)


def _text_runs(texts: list[str], limit: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of neighbouring texts of about ``limit`` characters."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


def _coded(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, list[memoryview]]]:
    """Of runs of rows: doc_ids, all ids, where each row's begin and end, and each row's decoded text."""
    bpe = _tables(spec)
    for batch in batches:
        texts, row = [t or "" for t in batch.column(1).to_pylist()], 0
        for part in _text_runs(texts):
            ids, stops, decoded, text_stops = bpe.encode(part)
            text_stops = text_stops.tolist()
            yield (batch.column(0).slice(row, len(part)), ids, stops,
                   [decoded[a:max(a, b - 1)] for a, b in zip(text_stops, text_stops[1:])])
            row += len(part)


def _coder(spec: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids, stops, decoded in _coded(batches, spec):
            lists = pa.ListArray.from_arrays(pa.array(stops, type=pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([doc_ids, lists, pa.array([str(t, "utf-8") for t in decoded], type=pa.string())],
                                             names=["doc_id", "ids", "decoded"])
    return run


def _digester(spec: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids, stops, decoded in _coded(batches, spec):
            raw, at = memoryview(ids.view(np.uint8)), (4 * stops).tolist()
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(np.diff(stops)), pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at, at[1:])]),
                 pa.array([hashlib.sha256(t).hexdigest() for t in decoded])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def read_spec(vocabulary: str) -> str:
    """The vocabulary file's JSON text; it goes to tasks by value, so executors need no copy of the file."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    config = json.loads(spec)
    if config.get("decoder") is not None:
        raise ValueError("only files without a decoder are supported")
    Bpe(spec)
    return spec


def encode_texts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` of every whole text."""
    return _texts(docs, id_col, text_col).mapInArrow(_coder(read_spec(vocabulary)), "doc_id long, ids array<int>, decoded string")


def token_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode_texts``, but with counts and digests in place of the ids and texts, made in the same pass."""
    return _texts(docs, id_col, text_col).mapInArrow(
        _digester(read_spec(vocabulary)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
