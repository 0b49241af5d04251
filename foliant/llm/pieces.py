"""SentencePiece encoding with seeded merge-dropout, and exact decoding.

Encoding follows the merge-type algorithm: symbols are characters, an agenda holds the neighbouring pairs whose union
is a piece, the best score (then the leftmost pair) is merged first.  With dropout, each candidate that comes up is
skipped for good if a hash of its place, keyed by seed and doc_id, falls below the rate.  The place is where its two
symbols start and end in the text, so every occurrence of a word has its own draws, and a document comes out the same
in any partition, order or batch.  Nothing is remembered and nothing rounded but the rate, to 64 binary places.

No piece has a space behind another character, so texts are cut there into parts that no merge joins.  The agendas of
many parts run side by side in arrays: a column for each part, whose least entry is its best pair.  Parts of more than
`SIDE` characters, rare outside of odd texts, run one by one on a heap.  Long texts are taken `CHUNK` characters at a
time, so memory does not grow with a text.

Characters without a piece, and a literal U+2581, become byte pieces: decoding gives back every text.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame

from foliant.llm.common import portions, texts

RATE, SEED = 0.1, 20_240_607
CHUNK, SIDE = 1 << 19, 256
SPACE = "▁"
_NONE = np.int64(1) << 62  # no candidate
# an agenda's entry: place of the score among all scores, place in the part, number of the piece that is made
_SCORE, _PLACE, _PIECE = 40, 22, (1 << 22) - 1
# Odd multipliers of a 64-bit mixing function.
_K = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9,
    0x94D049BB133111EB)))


def mixed(key: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of a candidate's bounds under a key; arrays of unsigned 64-bit words."""
    x = key + start * _K[0] + mid * _K[1] + end * _K[2]
    x ^= x >> np.uint64(30)
    x *= _K[3]
    x ^= x >> np.uint64(27)
    x *= _K[4]
    return x ^ (x >> np.uint64(31))


class Pairs:
    """(left rank, right rank) -> rank of what they make, as an open-addressed table that takes arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]) -> None:
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.made = np.full(1 << bits, -1, np.int32)
        for (a, b), r in pairs.items():
            at = int(self._slot(np.array([a << 32 | b], np.int64))[0])
            while self.keys[at] >= 0:
                at = at + 1 & int(self.mask)
            self.keys[at], self.made[at] = a << 32 | b, r

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * _K[0]) >> self.shift).astype(np.int64)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks, -1 where the two make no piece."""
        key = a.astype(np.int64) << np.int64(32) | b
        at = self._slot(key)
        found = self.keys[at]
        out = np.where(found == key, self.made[at], np.int32(-1))
        more = np.flatnonzero((found != key) & (found >= 0))
        while len(more):
            at[more] = at[more] + 1 & self.mask
            found, want = self.keys[at[more]], key[more]
            hit = found == want
            out[more[hit]] = self.made[at[more[hit]]]
            more = more[~hit & (found >= 0)]
        return out


class PieceCoder:
    """Encoder and decoder of one model file; rate 0 gives the model's own segmentation."""

    def __init__(self, path: str | None = None, rate: float = RATE, seed: int = SEED) -> None:
        import sentencepiece

        if not 0 <= rate <= 1:
            raise ValueError("a rate lies between 0 and 1")
        sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        n = sp.get_piece_size()
        scores: dict[str, float] = {}
        ids: dict[str, int] = {}
        self.raw: list[bytes] = [b""] * n
        self.byte = np.zeros(256, np.uint32)
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
                self.raw[i] = bytes([int(p[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                ids[p] = i
                scores[p] = sp.get_score(i)
                self.raw[i] = p.replace(SPACE, " ").encode()
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("a piece spans words")
        # a piece goes by its rank, best score first
        by_rank = sorted(scores, key=lambda p: (-scores[p], ids[p]))
        rank = {p: r for r, p in enumerate(by_rank)}
        self.id = np.array([ids[p] for p in by_rank], np.uint32)
        self.char = np.full(0x110000, -1, np.int32)
        for p, r in rank.items():
            if len(p) == 1:
                self.char[ord(p)] = r
        self.space = int(self.char[ord(SPACE)])
        self.char[ord(SPACE)], self.char[ord(" ")] = -1, self.space  # a literal mark goes by its bytes
        made = {(rank[p[:k]], rank[p[k:]]): r for p, r in rank.items() for k in range(1, len(p)) if p[:k] in rank
            and p[k:] in rank}
        self.pairs, self.one = Pairs(made), made
        order = {x: k for k, x in enumerate(sorted(set(scores.values()), reverse=True))}
        self.order = [order[scores[p]] for p in by_rank]
        # equal scores tie, as those of runs of spaces do: the leftmost goes first; the last entry serves number -1
        self.entry = np.append(np.array(self.order, np.int64) << _SCORE | np.arange(len(by_rank)), _NONE)
        self.beside = Pairs({(rank[a], rank[b]): 1 for p in ids for a, b in zip(p, p[1:]) if a in rank and b in rank})
        self.limit, self.seed = min(round(rate * 2**64), 2**64 - 1), seed
        self.all = rate == 1

    def key(self, doc_id: int | None) -> int:
        return int.from_bytes(hashlib.blake2b(f"{self.seed}:{doc_id}".encode(), digest_size=8).digest(), "little")

    def skipped(self, key: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether candidates are skipped."""
        if self.all or not self.limit:
            return np.full(len(start), self.all)
        return mixed(key, start.astype(np.uint64), mid.astype(np.uint64), end.astype(np.uint64)) < np.uint64(self.limit)

    def encode(self, text: str, doc_id: int | None = None) -> list[int]:
        """Piece ids; an empty text has none."""
        return self.encode_all([text], [doc_id])[0].tolist()

    def encode_all(self, given: list[str], doc_ids: list[int | None]) -> list[np.ndarray]:
        """Piece ids of each text; texts are taken together up to CHUNK characters."""
        out: list[list[np.ndarray]] = [[] for _ in given]
        held: list[tuple[int, int, str]] = []
        size = 0
        keys = [self.key(d) for d in doc_ids]

        def run() -> None:
            for (which, _, _), ids in zip(held, self._encoded(held, keys)):
                out[which].append(ids)
            held.clear()

        for which, text in enumerate(given):
            at = 0
            while at < len(text):
                to = self._cut(text, at, at + CHUNK)
                if held and size + to - at > CHUNK:
                    run()
                    size = 0
                held.append((which, at, text[at:to]))
                size += to - at
                at = to
        if held:
            run()
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.uint32) for x in out]

    @staticmethod
    def _cut(text: str, at: int, most: int) -> int:
        """A place to cut the text behind at: before spaces that follow something else, near most."""
        if most >= len(text):
            return len(text)
        to = at + len(text[at : text.rfind(" ", at, most) + 1].rstrip(" "))
        if to <= at:  # a single word, or spaces and one
            word = next((k for k in range(at, len(text)) if text[k] != " "), len(text)) if text[at] == " " else at
            to = text.find(" ", max(word, most))
            if to >= 0:
                to = word + len(text[word:to].rstrip(" "))
        return to if to > at else len(text)

    def _encoded(self, held: list[tuple[int, int, str]], keys: list[int]) -> list[np.ndarray]:
        """Ids of pieces of texts (number of the text, place of the piece in it, piece)."""
        cps, firsts, at = [], [], 0
        for _, offset, piece in held:
            own = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")
            firsts.append(at)
            if not offset:
                cps.append(np.array([32], "<u4"))  # the mark before the first word
            cps.append(own)
            at += len(own) + (not offset)
        cp, firsts = np.concatenate(cps), np.array(firsts + [at])
        sym = self.char[cp]
        lengths = np.diff(firsts)
        # a text's places count from its mark; the key and the shift of each piece, by position
        shift = np.array([offset + bool(offset) for _, offset, _ in held], np.int64) - firsts[:-1]
        key = np.array([keys[w] for w, _, _ in held], np.uint64)
        n = len(sym)
        cut = np.ones(n + 1, bool)
        is_space, bare = sym == self.space, sym < 0
        cut[1:n] = bare[1:] | bare[:-1] | (is_space[1:] & ~is_space[:-1])
        cut[firsts] = True
        sym, alive = self._merged(sym, cut, np.repeat(key, lengths), np.repeat(shift, lengths))
        return self._ids(sym, alive, cp, firsts)

    def _merged(self, sym: np.ndarray, cut: np.ndarray, key: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray,
            np.ndarray]:
        """Symbols after the merges at their first characters, and which of these are there."""
        n = len(sym)
        alive = np.ones(n, bool)
        starts = np.flatnonzero(cut[:-1])
        sizes = np.diff(np.append(starts, n))
        if (sizes > 64).any():  # only long parts are cut where no piece has the two characters side by side
            for s, size in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist()):
                own = sym[s : s + size]
                cut[s + 1 : s + size] |= self.beside.of(own[:-1], own[1:]) < 0
            starts = np.flatnonzero(cut[:-1])
            sizes = np.diff(np.append(starts, n))
        end, head = np.arange(1, n + 1), np.arange(n)
        first = np.full(n, -1, np.int32)  # what a character makes with the next one of its part
        inside = np.flatnonzero(~cut[1:n])
        first[inside] = self.pairs.of(sym[inside], sym[inside + 1])
        low = 1
        for width in [*(w for w in (*range(2, 17), 24, 32, 48, 64, 128) if w < SIDE), SIDE]:
            base = starts[(sizes > low) & (sizes <= width)]
            if len(base):
                size = sizes[(sizes > low) & (sizes <= width)]
                self._side_by_side(base, base + size, width, first, sym, alive, end, head, key[base], shift[base])
            low = width
        for s, size in zip(starts[sizes > SIDE].tolist(), sizes[sizes > SIDE].tolist()):
            self._one(s, s + size, sym, alive, key[s : s + 1], int(shift[s]))
        return sym, alive

    def _side_by_side(self, base, stop, width, first, sym, alive, end, head, key, shift) -> None:
        """Agendas of parts of at most width characters: entry k of a column is the pair that starts at character k."""
        rows = np.arange(width - 1)[:, None]
        at = base[None, :] + rows
        agenda = self.entry[np.where(at + 1 < stop[None, :], first[np.minimum(at, len(first) - 1)],
            -1)] | rows << _PLACE
        while True:
            best = agenda.min(axis=0)
            live = best < _NONE
            if not live.all():
                keep = np.flatnonzero(live)
                if not len(keep):
                    return
                agenda, best, base, stop, key, shift = agenda[:,
                    keep], best[keep], base[keep], stop[keep], key[keep], shift[keep]
            i, made = (best & (1 << _SCORE) - 1) >> _PLACE, (best & _PIECE).astype(np.int32)
            a = base + i
            b = end[a]
            c = end[b]
            cols = np.arange(len(a))
            agenda[i, cols] = _NONE
            take = np.flatnonzero(~self.skipped(key, a + shift, b + shift, c + shift))
            if not len(take):
                continue
            i, made, a, b, c, own, cols = i[take], made[take], a[take], b[take], c[take], base[take], take
            sym[a], end[a], head[c - 1], alive[b] = made, c, a, False
            right = b - own
            inner = np.flatnonzero(right < width - 1)
            agenda[right[inner], cols[inner]] = _NONE
            on = np.flatnonzero(c < stop[take])
            agenda[i[on], cols[on]] = self.entry[self.pairs.of(made[on], sym[c[on]])] | i[on] << _PLACE
            on = np.flatnonzero(i > 0)
            p = head[a[on] - 1]
            k = p - own[on]
            agenda[k, cols[on]] = self.entry[self.pairs.of(sym[p], made[on])] | k << _PLACE

    def _one(self, a: int, z: int, sym: np.ndarray, alive: np.ndarray, key: np.ndarray, shift: int) -> None:
        """The agenda of one long part, as a heap with links to the neighbours."""
        own = sym[a:z].tolist()
        n, pairs = len(own), self.one
        end, prev, nxt, there = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = nxt[i]
            if j < n and (r := pairs.get((own[i], own[j]))) is not None:
                heapq.heappush(heap, (self.order[r], i, end[i], end[j], r))

        for i in range(n - 1):
            offer(i)
        at = shift + a
        while heap:
            _, i, mid, last, best = heapq.heappop(heap)
            if not there[i] or end[i] != mid or mid >= n or end[mid] != last:
                continue
            if self.skipped(key, *(np.array([at + x]) for x in (i, mid, last)))[0]:
                continue
            j = nxt[i]
            there[j] = False
            own[i], end[i], nxt[i] = best, last, nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            if prev[i] >= 0:
                offer(prev[i])
            offer(i)
        sym[a:z], alive[a:z] = own, there

    def _ids(self, sym: np.ndarray, alive: np.ndarray, cp: np.ndarray, firsts: np.ndarray) -> list[np.ndarray]:
        """Ids of the symbols that are there, by piece of text; characters without a piece by their UTF-8 bytes."""
        at = np.flatnonzero(alive)
        own, code = sym[at], cp[at].astype(np.int64)
        bare = own < 0
        count = np.where(bare, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
        stops = np.cumsum(count)
        out = np.empty(int(stops[-1]) if len(stops) else 0, np.uint32)
        begin = stops - count
        out[begin[~bare]] = self.id[own[~bare]]
        for size in range(1, 5):
            on = np.flatnonzero(bare & (count == size))
            if len(on):
                x, to = code[on], begin[on]
                lead = (0, 0, 0xC0, 0xE0, 0xF0)[size]
                out[to] = self.byte[lead | x >> 6 * (size - 1)]
                for k in range(1, size):
                    out[to + k] = self.byte[0x80 | x >> 6 * (size - 1 - k) & 0x3F]
        cuts = np.append(begin, len(out))[np.searchsorted(at, firsts)]
        return [out[a:b] for a, b in zip(cuts, cuts[1:])]

    def decode(self, ids: list[int]) -> str:
        """The text that encode was given."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


_coders: dict[tuple, PieceCoder] = {}


def coder(path: str | None, rate: float, seed: int) -> PieceCoder:
    """One coder for each setting and process."""
    return _coders.get((path, rate, seed)) or _coders.setdefault((path, rate, seed), PieceCoder(path, rate, seed))


def _runs(batch: pa.RecordBatch, c: PieceCoder) -> Iterator[tuple[pa.RecordBatch, list[str], list[np.ndarray]]]:
    """Parts of a batch of (doc_id, text) with their texts and ids; null texts are empty."""
    for at, n in portions(pc.coalesce(pc.binary_length(batch.column(1)), 0).to_pylist(), CHUNK):
        part = batch.slice(at, n)
        own = [t or "" for t in part.column(1).to_pylist()]
        yield part, own, c.encode_all(own, part.column(0).to_pylist())


def encode(docs: DataFrame, rate: float = RATE, seed: int = SEED, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row; null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, rate, seed)
        for b in batches:
            for part, _, ids in _runs(b, c):
                yield pa.RecordBatch.from_arrays([part.column(0),
                    pa.array([x.astype("<i4") for x in ids], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give null, no ids the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, 0.0, SEED)
        for b in batches:
            for at in range(0, len(b), 100):
                part = b.slice(at, 100)
                found = [None if x is None else c.decode(x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.string())],
                    names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


_REPORT = "doc_id long, n_chars long, n_pieces long, ids_crc32 long, decoded_sha256 string, lossless boolean"
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())


def report(docs: DataFrame, rate: float = RATE, seed: int = SEED, path: str | None = None) -> DataFrame:
    """Encode and decode every row: counts, a digest of the ids (little-endian unsigned 32-bit) and of the decoded text."""
    names = [c.split()[0] for c in _REPORT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, rate, seed)
        for b in batches:
            for part, own, ids in _runs(b, c):
                rows = []
                for doc_id, text, x in zip(part.column(0).to_pylist(), own, ids):
                    back = c.decode(x.tolist())
                    rows.append((doc_id, len(text), len(x), crc32(x.astype("<u4").tobytes()),
                        hashlib.sha256(back.encode()).hexdigest(), back == text))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), _TYPES)], names=names)

    return texts(docs).mapInArrow(run, _REPORT)
