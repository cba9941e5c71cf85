"""BPE as a bounded-lookahead streaming transducer, and an incremental decoder.

A text is read in chunks that end after white space. Each chunk is normalised and cut into pieces,
and each piece is merged. `lookahead` computes from the merge list how many symbols to the right
can influence whether two neighbours merge; a boundary further than that from the end of what has
been read is final, so its tokens are emitted and forgotten. State is one window of symbols.

Tokenizers of this shape are understood: added special tokens matched in the raw text, NFC and
lower case, a split into contractions, letters, single digits and other signs, byte symbols, an
end-of-word suffix, and no decoder (tokens are joined by a space). `Vocabulary` refuses others.

Null text counts as empty: no tokens, empty decoded text. Null or repeated ids keep their rows;
columns other than id and text are not read. Very long texts and words need no more memory than
one window besides the text itself.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

CHUNK = 1 << 16
CACHED_WORDS = 60_000  # memory bound of each of the two generations of the memo of merged pieces
ROWS = 256  # texts that are held at once
NEVER = 1 << 30  # rank of a pair that doesn't merge
SHIFT = 30
CACHED_LENGTH = 32  # symbols of the longest piece that is kept in the memo
TOGETHER = 1 << 20  # characters whose pieces are merged together
MAX_VOCABULARY_BYTES = 64 << 20  # what is broadcast is checked against this

PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
SPACE = regex.compile(r"\p{White_Space}")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def lookahead(merges: list[tuple[str, str]], suffix: str) -> int:
    """Symbols to the right of a boundary that suffice to know whether it is final.

    Whether the pair (a, b) merges can differ with later text only if a merge of smaller rank, with
    a left part that ends inside b or at its end, differs first. So the reach of a merge is the
    distance to such an inner end plus that earlier merge's own reach; merges are visited by rank.
    """
    parts: dict[str, tuple[str, str]] = {}
    farthest: dict[str, int] = {}  # by left part: the farthest reach so far

    def size(token: str) -> int:
        return len(token.removesuffix(suffix)) or 1

    def ends(token: str) -> int:
        """The farthest reach of merges whose left part ends where `token` ends."""
        most = farthest.get(token, 0)
        while token in parts:
            token = parts[token][1]
            most = max(most, farthest.get(token, 0))
        return most

    longest = 0
    for left, right in merges:
        reach = size(right) + ends(right)
        todo = [(right, 0)]
        while todo:
            token, at = todo.pop()
            if token in parts:
                a, b = parts[token]
                inner = at + size(a)
                reach = max(reach, inner + ends(a))
                todo += [(a, at), (b, inner)]
        farthest[left] = max(farthest.get(left, 0), reach)
        longest = max(longest, reach)
        if left + right in parts:
            raise ValueError("two merges make the same token")
        parts[left + right] = (left, right)
    return longest


class Vocabulary:
    def __init__(self, spec: str, reach: int | None = None):
        self.spec = spec
        data = json.loads(spec)
        model = data["model"]
        steps = [n["type"] for n in data["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or data["decoder"] is not None:
            raise ValueError("this shape of tokenizer is not supported")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]):
            raise ValueError("added tokens must be plain")
        self.suffix: str = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        #: by the pair's two ids in one number: its rank; by rank: the id that the pair becomes
        self.ranks = {self.ids[a] << SHIFT | self.ids[b]: r for r, (a, b) in enumerate(self.merges)}
        self.made = [self.ids[a + b] for a, b in self.merges]
        if not all(c + end in self.ids for c in byte_symbols() for end in ("", self.suffix)):
            raise ValueError("every byte needs a token")
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.reach = lookahead(self.merges, self.suffix) if reach is None else reach
        self.lengths = {i: len(t.removesuffix(self.suffix)) for t, i in self.ids.items()}
        self.longest = max(self.lengths.values())


#: A piece's token ids.
Merged = tuple[int, ...]


class Encoder:
    """Streams texts to tokens. One per Python worker; `words` is its bounded memo."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = v = vocabulary
        self.symbols = {b: s for b, s in enumerate(byte_symbols())}
        self.inner = {c: v.ids[c] for c in byte_symbols()}
        self.final = {c: v.ids[c + v.suffix] for c in byte_symbols()}
        self.tables = np.zeros((2, 1024), np.int64)  # the same by code point
        for c in byte_symbols():
            self.tables[:, ord(c)] = self.inner[c], self.final[c]
        order = sorted(v.ranks)
        self.keys, self.key_ranks = np.array(order), np.array([v.ranks[k] for k in order])
        self.made = np.array(v.made)
        self.piece = regex.compile(PIECE)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(v.special, key=len, reverse=True))) + ")") if v.special else None
        self.window = max(3 * v.reach + v.longest, CACHED_LENGTH)
        self.words: dict[str, Merged] = {}
        self.older: dict[str, Merged] = {}  # the generation before; what is used again moves up
        self.library = None

    def merged(self, ids: list[int]) -> list[int]:
        """`ids` after all merges, smallest rank first and leftmost among equals."""
        rank, made, n = self.v.ranks.get, self.v.made, len(ids)
        order = [rank(a << SHIFT | b, NEVER) for a, b in zip(ids, ids[1:])]
        if n <= 48:
            while order:
                first = min(order)
                if first == NEVER:
                    break
                i = order.index(first)
                ids[i] = made[first]
                del ids[i + 1], order[i]
                if i:
                    order[i - 1] = rank(ids[i - 1] << SHIFT | ids[i], NEVER)
                if i < len(order):
                    order[i] = rank(ids[i] << SHIFT | ids[i + 1], NEVER)
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, r in enumerate(order) if r != NEVER]
        heapq.heapify(heap)
        order.append(NEVER)
        while heap:
            r, i = heapq.heappop(heap)
            if order[i] != r:
                continue
            j = after[i]
            ids[i], ids[j], order[j], after[i] = made[r], -1, NEVER, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0:
                    order[x] = rank(ids[x] << SHIFT | ids[y], NEVER) if y < n else NEVER
                    if order[x] != NEVER:
                        heapq.heappush(heap, (order[x], x))
        return [i for i in ids if i >= 0]

    def stream(self, symbols: str) -> Iterator[int]:
        """The tokens of one piece, each given out once no later symbol can change it."""
        at, lengths = 0, self.v.lengths
        while len(symbols) - at > self.window:
            end = at + self.window
            final = end - self.v.reach
            for token in self.merged([self.inner[c] for c in symbols[at:end]]):
                if at + lengths[token] > final:
                    break
                at += lengths[token]
                yield token
        yield from self.merged([*map(self.inner.__getitem__, symbols[at:-1]), self.final[symbols[-1]]])

    def bulk(self, words: list[str]) -> list[list[int]]:
        """As `merged`, for many short pieces at once: one row each, one merge a row and round."""
        n, size = len(words), np.fromiter(map(len, words), np.int64, len(words))
        width = int(size.max()) + 1
        ids = np.full((n, width), -1)
        symbols = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ids[np.arange(width) < size[:, None]] = self.tables[0][symbols]
        ids[np.arange(n), size - 1] = self.tables[1][symbols[np.cumsum(size) - 1]]
        rank, out, row = self.pair_ranks(ids[:, :-1], ids[:, 1:]), np.full((n, width), -1), np.arange(n)
        at_id, at_rank = np.arange(width), np.arange(width - 1)
        while len(row):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(row)), at]
            more = best < NEVER
            out[row[~more]] = ids[~more]
            row, ids, rank, at, best = row[more], ids[more], rank[more], at[more], best[more]
            every = np.arange(len(row))
            ids[every, at] = self.made[best]
            ids = np.take_along_axis(ids, np.minimum(at_id + (at_id > at[:, None]), width - 1), axis=1)
            rank = np.take_along_axis(rank, np.minimum(at_rank + (at_rank >= at[:, None]), width - 2), axis=1)
            ids[:, -1], rank[:, -1] = -1, NEVER
            rank[every, at] = self.pair_ranks(ids[every, at], ids[every, at + 1])
            inner = np.flatnonzero(at)
            rank[inner, at[inner] - 1] = self.pair_ranks(ids[inner, at[inner] - 1], ids[inner, at[inner]])
        return [r[:k] for r, k in zip(out.tolist(), (out >= 0).sum(axis=1).tolist())]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = np.where((left < 0) | (right < 0), -1, left << SHIFT | right)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.key_ranks[at], NEVER)

    def of_symbols(self, symbols: str) -> Merged:
        return tuple(self.stream(symbols))

    def pieces(self, text: str) -> list[str | Merged]:
        """The pieces of a stretch without special tokens."""
        if not text.isascii():
            if any(unicodedata.category(c) == "Cn" for c in set(text)):  # a newer library may class these otherwise
                return self.by_library(text)
            text = unicodedata.normalize("NFC", text)
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        return self.piece.findall(text)

    def by_library(self, text: str) -> list[str | Merged]:
        """As `pieces`, with normalising and cutting left to the library, whose Unicode is its own."""
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_str(self.v.spec)
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [self.of_symbols(symbols) for symbols, _ in cut]

    def chunks(self, text: str) -> Iterator[tuple[int, list[str | Merged]]]:
        """The text's pieces, chunk after chunk (with its length). No piece or special token crosses white space."""
        at = 0
        while at < len(text):
            cut = SPACE.search(text, at + CHUNK)
            end = cut.end() if cut else len(text)
            chunk, size, at = text[at:end], end - at, end
            if self.marks is None or "<" not in chunk:
                yield size, self.pieces(chunk)
                continue
            found: list[str | Merged] = []
            for k, part in enumerate(self.marks.split(chunk)):
                found += [(self.v.special[part],)] if k % 2 else self.pieces(part)
            yield size, found

    def known(self, chunks: list[list[str | Merged]]) -> dict:
        """What every piece of the chunks becomes; pieces seen before come from the memo."""
        out = {}
        for piece in set().union(*chunks):
            out[piece] = piece if type(piece) is tuple else self.words.get(piece) or self.older.get(piece)
        new = [p for p, got in out.items() if got is None]
        short = []
        for piece in new:
            symbols = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.symbols)
            if len(symbols) <= CACHED_LENGTH:
                short.append((piece, symbols))
            else:
                out[piece] = self.of_symbols(symbols)
        for at in range(0, len(short), 4096):
            some = short[at:at + 4096]
            for (piece, _), ids in zip(some, self.bulk([s for _, s in some])):
                out[piece] = tuple(ids)
        if len(self.words) + len(short) > CACHED_WORDS:
            self.older, self.words = self.words, {}
        self.words.update((p, out[p]) for p, _ in short[:CACHED_WORDS])
        return out

    def run(self, texts: list[str]) -> Iterator[tuple[int, list[Merged]]]:
        """(number of the text, merged pieces of its next chunk), some chunks being merged together."""
        held, size = [], 0
        for k, text in enumerate(texts):
            for length, chunk in self.chunks(text):
                held.append((k, chunk))
                size += length
                if size >= TOGETHER:
                    yield from self.flush(held)
                    held, size = [], 0
        yield from self.flush(held)

    def flush(self, held: list) -> Iterator[tuple[int, list[Merged]]]:
        merged = self.known([c for _, c in held])
        for k, chunk in held:
            yield k, list(map(merged.__getitem__, chunk))

    def ids(self, text: str) -> list[int]:
        return [i for _, chunk in self.run([text]) for piece in chunk for i in piece]


class Decoder:
    """Ids to the library's decoded text, piece by piece: its tokens joined by a space."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens, self.begun = vocabulary.tokens, False

    def feed(self, ids) -> str:
        text = " ".join(map(self.tokens.__getitem__, ids))
        text = f" {text}" if self.begun and text else text
        self.begun |= bool(text)
        return text


class TextDecoder:
    """Ids to readable text: byte symbols go through an incremental UTF-8 machine, word ends become spaces."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.bytes = {s: b for b, s in enumerate(byte_symbols())}
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        out = []
        for i in ids:
            token = self.v.tokens[i]
            if token in self.v.special:
                out.append(self.machine.decode(b"", True) + token + " ")
                self.machine.reset()
                continue
            ends = token.endswith(self.v.suffix)
            out.append(self.machine.decode(bytes(self.bytes[c] for c in token.removesuffix(self.v.suffix)), ends))
            if ends:
                self.machine.reset()
                out.append(" ")
        return "".join(out)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(spec: str, reach: int) -> Encoder:
    """This worker's encoder, made once."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Vocabulary(spec, reach))
    return _ENCODERS[key]


def _shared(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    if len(spec) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"the tokenizer file is over {MAX_VOCABULARY_BYTES} bytes")
    return docs.sparkSession.sparkContext.broadcast((spec, Vocabulary(spec).reach))


def _slices(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids array<int>, decoded string (the library's decode of the ids)."""
    shared = _shared(docs, tokenizer_path)

    def run(batches):
        encoder = _encoder(*shared.value)
        for batch in _slices(batches):
            ids = [encoder.ids(t) if t else [] for t in batch.column(1).to_pylist()]
            text = [Decoder(encoder.v).feed(x) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(text, pa.string())], ["doc_id", "ids", "decoded"])

    return _map(docs, id_col, text_col, run, "ids array<int>, decoded string")


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens and SHA-256 of the ids and of the decoded text, both taken as tokens are emitted.

    A text's emitted ids go straight to its decoder, which carries on where it was.
    """
    shared = _shared(docs, tokenizer_path)

    def run(batches):
        encoder = _encoder(*shared.value)
        numbers = [str(i) for i in range(max(encoder.v.tokens) + 1)]
        for batch in _slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts, decoders = [0] * len(texts), [Decoder(encoder.v) for _ in texts]
            ids, decoded = ([hashlib.sha256() for _ in texts] for _ in range(2))
            for k, chunk in encoder.run(texts):
                flat = list(chain.from_iterable(chunk))
                if flat:
                    ids[k].update(((" " if counts[k] else "") + " ".join(map(numbers.__getitem__, flat))).encode())
                    decoded[k].update(decoders[k].feed(flat).encode())
                    counts[k] += len(flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array([h.hexdigest() for h in ids], pa.string()),
                                              pa.array([h.hexdigest() for h in decoded], pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _map(docs, id_col, text_col, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _map(docs: DataFrame, id_col: str, text_col: str, run, columns: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, f"doc_id {kind}, {columns}")
