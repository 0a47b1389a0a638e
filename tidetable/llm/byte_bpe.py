"""Byte-level BPE by backtracking over the longest matches of an Aho-Corasick automaton.

A sequence of tokens is what the merges give exactly when every adjacent pair is: merging the bytes of the pair gives
that pair. The encoder therefore takes the longest token at each place, as long as it is compatible with the token
before it, and steps back to a shorter one where none is. Compatibility is looked up in a table of pairs already
tried. A token is tried at most once per place, so the time is linear in the piece.

Bytes stand as Latin-1 characters in the automaton, which works on text. A piece that is a token as a whole is that
token. Null texts are empty; an empty text has no ids and decodes to no bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from tidetable.llm.chunks import PieceTable, pieces_of
from tidetable.llm.packing import default_ranks, read_ranks
from tidetable.llm.shared import ship, slices, text_of

NO_RANK = 1 << 60
KEPT_DIGESTS = 300_000
SLOTS = 1 << 21
SPREAD = -7046029254386353131  # an odd number that spreads keys over slots
MASK = (1 << 32) - 1
BETWEEN = "\u0100"  # between words: no byte's character, so no match crosses it
TEXT_AT_ONCE = 2_000_000


def pairs_of(found: Iterator[tuple[int, int]]) -> np.ndarray:
    """Matches as rows of last place and rank."""
    return np.fromiter(chain.from_iterable(found), np.int64).reshape(-1, 2)


class BacktrackingEncoder:
    """Encodes and decodes by the ranks of a vocabulary that holds every single byte."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.words = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.halves_of: dict[int, tuple[int, int] | None] = {}
        most = max(ranks.values()) + 1
        self.sizes, self.shorter_of = np.zeros(most, np.int64), np.full(most, -1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank], self.shorter_of[rank] = len(token), self.shorter(rank)
        # pairs met so far; of two pairs that share a slot the later one stays
        self.known_keys, self.known = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)

    def merged(self, piece: bytes, down_to: int = 1) -> list[bytes]:
        """The merges spelled out, lowest rank first and leftmost among equals; for single tokens."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > down_to:
            rank, at = min((self.ranks.get(a + b, NO_RANK), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NO_RANK:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives this one; None for a byte or a token that no merge gives."""
        if token not in self.halves_of:
            parts = self.merged(self.bytes_of[token], 2)
            given = len(parts) == 2 and self.ranks.get(parts[0] + parts[1]) == token
            self.halves_of[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if given else None
        return self.halves_of[token]

    def reachable(self, token: int) -> bool:
        """Whether merges give this token at all."""
        return len(self.bytes_of[token]) == 1 or self.halves(token) is not None

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both leaves these two tokens.

        Undo the later of the two last merges, again and again, and look at the tokens that then face each other:
        a merge over the border would have come first if its rank is below that of the merge undone last.
        Among equal ranks the left one comes first.
        """
        if not (self.reachable(left) and self.reachable(right)):
            return False
        ranks, bytes_of = self.ranks, self.bytes_of
        before = NO_RANK  # a merge over the border of a rank below this would have come first
        a, b = left, right
        while True:
            if ranks.get(bytes_of[a] + bytes_of[b], NO_RANK) < before:
                return False
            of_a, of_b = self.halves(a), self.halves(b)
            if of_a is None and of_b is None:
                return True
            if of_b is None or (of_a is not None and a > b):
                before, a = a, of_a[1]
            else:
                before, b = b + 1, of_b[0]

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of this one, or -1."""
        held = self.bytes_of[token]
        for size in range(len(held) - 1, 0, -1):
            if (found := self.ranks.get(held[:size])) is not None:
                return found
        return -1

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Pair by pair, whether two tokens may stand side by side; -1 on the left is the beginning of a piece."""
        keys = ((left + 1) << 32) | right
        slots = ((keys * SPREAD) >> 40) & (SLOTS - 1)
        new = np.flatnonzero(self.known_keys[slots] != keys)
        found = self.known[slots]
        if len(new):
            pairs, back = np.unique(keys[new], return_inverse=True)
            fits = np.array([
                self.reachable(key & MASK) if key >> 32 == 0 else self.stay_apart((key >> 32) - 1, key & MASK)
                for key in pairs.tolist()
            ])
            found[new] = fits[back]
            at = ((pairs * SPREAD) >> 40) & (SLOTS - 1)
            self.known_keys[at] = pairs
            self.known[at] = fits[np.searchsorted(pairs, self.known_keys[at])]  # of two in one slot, the one that stayed
        return found

    def many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many matches of the pattern, one after the other, and how many each has."""
        spelled = [word.encode().decode("latin-1") for word in words]
        sizes = np.fromiter(map(len, spelled), np.int64, len(words))
        found = pairs_of(self.automaton.iter_long(BETWEEN.join(spelled)))
        ids, ends = found[:, 1], np.cumsum(sizes + 1) - 1
        word = np.searchsorted(ends, found[:, 0], side="right")
        begins = np.r_[True, word[1:] != word[:-1]]
        counts = np.bincount(word, minlength=len(words))
        left = np.where(begins, -1, np.r_[-1, ids[:-1]])
        several = counts[word] > 1  # a piece that is a token as a whole is that token
        ok = np.ones(len(ids), bool)
        ok[several] = self.compatible(left[several], ids[several])
        bad = np.unique(word[~ok])
        if not len(bad):
            return ids, counts
        mended, of_bad = self.backtrack([spelled[i] for i in bad.tolist()])
        keep = np.ones(len(words), bool)
        keep[bad] = False
        order = np.concatenate([word[keep[word]], np.repeat(bad, of_bad)])
        counts[bad] = of_bad
        return np.concatenate([ids[keep[word]], mended])[np.argsort(order, kind="stable")], counts

    def backtrack(self, spelled: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The longest compatible token at each place of each word, with steps back from places where none fits.

        All words take their steps together. A place found to lead nowhere is closed and not entered again.
        """
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        ends = np.cumsum(sizes + 1) - 1
        matches = pairs_of(self.automaton.iter(BETWEEN.join(spelled)))
        longest = np.full(int(ends[-1]) + 1, -1, np.int64)
        starts = matches[:, 0] - self.sizes[matches[:, 1]] + 1
        order = np.argsort(self.sizes[matches[:, 1]], kind="stable")
        longest[starts[order]] = matches[order, 1]  # the last one written is the longest
        closed = np.zeros(len(longest) + 1, bool)
        at, depth = ends - sizes, np.zeros(len(spelled), np.int64)
        taken = np.zeros((len(spelled), int(sizes.max()) + 1), np.int64)
        taken[:, 0] = -1  # taken[w, depth] is the token before the current place
        token, active = longest[at], np.arange(len(spelled))
        while len(active):
            stuck = active[token[active] < 0]
            if len(stuck):
                closed[at[stuck]] = True
                last = taken[stuck, depth[stuck]]
                depth[stuck] -= 1
                at[stuck] -= self.sizes[last]
                token[stuck] = self.shorter_of[last]
                active = active[token[active] >= 0] if (token[stuck] >= 0).all() else active
                continue
            now = token[active]
            end = at[active] + self.sizes[now]
            fits = ~closed[end]
            fits[fits] = self.compatible(taken[active, depth[active]][fits], now[fits])
            go, stay = active[fits], active[~fits]
            token[stay] = self.shorter_of[token[stay]]
            depth[go] += 1
            taken[go, depth[go]] = token[go]
            at[go] = end[fits]
            token[go] = np.where(at[go] < ends[go], longest[np.minimum(at[go], ends[go])], 0)
            active = active[at[active] < ends[active]]
        taken, width = taken[:, 1:], int(sizes.max())
        return taken[np.arange(width) < depth[:, None]], depth

    def encode(self, text: str) -> list[int]:
        """Ids of a text: each match of the pattern encoded by itself."""
        words = self.words.findall(text)
        return self.many(words)[0].tolist() if words else []

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class DigestTable(PieceTable):
    """Per piece: how many ids, the ids as text, and the bytes they decode to."""

    def __init__(self, encoder: BacktrackingEncoder):
        super().__init__(KEPT_DIGESTS)
        self.encoder = encoder
        self.names = {rank: str(rank) for rank in encoder.bytes_of}

    def of_ids(self, ids: list[int]) -> tuple[int, str, bytes]:
        return len(ids), " ".join(map(self.names.__getitem__, ids)), self.encoder.decode(ids)

    def encode_pieces(self, pieces: list[str]) -> list[tuple[int, str, bytes]]:
        """Results of pieces, cut at the matches of the pattern, all encoded together."""
        words, cuts = [], [0]
        for piece in pieces:
            words += self.encoder.words.findall(piece)
            cuts.append(len(words))
        if not words:
            return [self.of_ids([]) for _ in pieces]
        ids, counts = self.encoder.many(words)
        ids, cuts = ids.tolist(), np.r_[0, np.cumsum(counts)][cuts].tolist()
        return [self.of_ids(ids[a:b]) for a, b in zip(cuts, cuts[1:])]

    def results(self, texts: list[str]) -> Iterator[list[tuple[int, str, bytes]]]:
        """Per text the results of its pieces, in order."""
        split = [pieces_of(text) for text in texts]
        # first pieces and texts that can't be split are encoded whole
        heads = self.encode_pieces([text if pieces is None else pieces[0] for text, pieces in zip(texts, split)])
        found = [[] if pieces is None else list(map(self.held.get, pieces[1:])) for pieces in split]
        missing: dict[str, tuple] = {}
        for pieces, results in zip(split, found):
            if None in results:
                missing.update((pieces[i], None) for i, x in enumerate(results, 1) if x is None)
        for piece, result in zip(list(missing), self.encode_pieces([" " + piece for piece in missing])):
            missing[piece] = result
            self.put(piece, result)
        for head, pieces, results in zip(heads, split, found):
            if None in results:
                results = [missing[pieces[i]] if x is None else x for i, x in enumerate(results, 1)]
            yield [head, *results]


@lru_cache(maxsize=2)
def encoder(path: str) -> BacktrackingEncoder:
    import public_tokenizers

    return BacktrackingEncoder(read_ranks(path), public_tokenizers.PATTERN)


@lru_cache(maxsize=2)
def _table(path: str) -> DigestTable:
    return DigestTable(encoder(path))


def _encoding(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path).encode
        for batch in batches:
            ids = [ids_of(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return encode


def _digests(path: str):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(path)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            texts = batch.column(1)
            parts = (texts.slice(a, b - a).to_pylist() for a, b in slices(pc.utf8_length(texts).to_numpy(), TEXT_AT_ONCE))
            for found in chain.from_iterable(map(table.results, parts)):
                counts.append(sum([x[0] for x in found]))
                of_ids.append(hashlib.sha256(" ".join([x[1] for x in found if x[0]]).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(b"".join([x[2] for x in found])).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def _given(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None) -> DataFrame:
    """``doc_id, ids``: one row per input row."""
    return _given(docs, doc_id, text).mapInArrow(_encoding(ranks or default_ranks()), "doc_id long, ids array<int>")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text's ids and of the bytes they decode to."""
    columns = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _given(docs, doc_id, text).mapInArrow(_digests(ranks or default_ranks()), columns)
