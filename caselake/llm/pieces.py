"""SentencePiece encoding and decoding in numpy, many words at a time.

The vocabulary file gives pieces and scores and says how they are applied.
Texts are cut into words wherever no piece can span the cut; the distinct words
of a slice advance together by equal length, and hashes of their substrings
probe the sorted hashes of the pieces.

- Unigram files: batched Viterbi. For every end position the hashes of all
  substrings that end there are probed, a vectorised maximum over the sums of
  scores picks the best piece and stores its length and id as backpointers.
  Scores are summed as they stand in the file, in float64; of equal sums the one
  with the longest last piece wins.
- Merge (BPE) files define their tokens by the order of merges, which no sum of
  scores reproduces. There all words advance together by one merge a round: a
  vectorised maximum over neighbouring pairs, whose concatenations are probed
  in the same keys, picks the best pair of every word.

Work is on UTF-8 bytes with the piece marker as a plain space. A character that
no piece covers becomes one byte piece per byte, so decoding always returns the
very bytes that were encoded.

Defined results: a null text has no tokens and decodes to the empty text; a
literal piece marker (U+2581) in a text is an ordinary character; invalid UTF-8
comes back byte by byte. The vocabulary (one model file) is a parameter and
broadcast; documents are never shuffled.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from caselake.llm.common import plain, table
from caselake.llm.textnp import BASES, RollingHash, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Below the score of any segmentation.
_NEVER = -float(1 << 60)
#: What a character without a piece costs beyond the worst piece.
_UNKNOWN_PENALTY = 10
#: Substrings looked up at once, and words remembered between the slices of a task.
_PROBES = 1 << 17
_REMEMBERED = 1 << 18
#: Bytes of words that advance together.
_TOGETHER = 1 << 18
_TABLE_BITS = 20
#: From this length on words are merged one by one with a heap.
_LONG = 256
#: Bytes of text per slice: many repeated words meet in one.
_SLICE = 1 << 19
U64 = np.uint64


@dataclass
class Vocabulary:
    """Pieces by sorted hash, the bytes of every id, and which byte pairs occur inside pieces."""

    keys: np.ndarray
    key_id: np.ndarray
    score: np.ndarray
    longest: int
    byte_id: np.ndarray
    unknown: float
    table: np.ndarray
    pairs: np.ndarray
    blob: np.ndarray
    bounds: np.ndarray
    merges: bool


def load(path: str = MODEL, rule: str | None = None) -> Vocabulary:
    """Reads a SentencePiece model file with byte pieces; ``rule`` ("unigram" or "bpe") overrides the file's own."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    model = SentencePieceProcessor(model_file=path)
    if rule is None:
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model.serialized_model_proto())
        rule = {1: "unigram", 2: "bpe"}[proto.trainer_spec.model_type]
    n = model.vocab_size()
    score = np.zeros(n)
    byte_id = np.full(256, model.unk_id(), np.int64)
    raw, normal = [], []
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_id[value] = i
            raw.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            raw.append(piece.replace(MARK, " ").encode())
            score[i] = model.get_score(i)
            normal.append(i)
    pairs = np.zeros(1 << 16, bool)
    for i in normal:
        b = np.frombuffer(raw[i], np.uint8).astype(np.int64)
        pairs[b[:-1] * 256 + b[1:]] = True
    blob = np.frombuffer(b"".join(raw), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    normal = np.array(normal)
    key = RollingHash(blob)(bounds[normal], bounds[normal + 1])
    order = np.argsort(key)
    known = np.zeros(1 << _TABLE_BITS, bool)
    known[(key >> U64(64 - _TABLE_BITS)).astype(np.int64)] = True
    return Vocabulary(key[order], normal[order], score, int(np.diff(bounds)[normal].max()), byte_id,
                      float(score[normal].min()) - _UNKNOWN_PENALTY, known, pairs, blob, bounds, rule == "bpe")


def _probe(v: Vocabulary, key: np.ndarray) -> np.ndarray:
    """Piece id of every hash, -1 where there is none."""
    out = np.full(key.shape, -1, dtype=np.int64)
    maybe = v.table[(key >> U64(64 - _TABLE_BITS)).astype(np.int64)]
    candidates = key[maybe]
    slot = np.minimum(np.searchsorted(v.keys, candidates), len(v.keys) - 1)
    out[maybe] = np.where(v.keys[slot] == candidates, v.key_id[slot], -1)
    return out


def _char_starts(data: np.ndarray) -> np.ndarray:
    """Places where a character may begin; after three continuation bytes every byte may."""
    inner = (data & 0xC0) == 0x80
    start = ~inner
    run = inner[3:] & inner[2:-1] & inner[1:-2] & inner[:-3]
    start[3:] |= run
    return start


def viterbi(v: Vocabulary, data: np.ndarray, roll: RollingHash, begins: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Token ids of words of one length: a matrix with each id at the byte where it begins, -1 elsewhere.

    ``first``: where the words begin in ``data``; ``begins``: where characters begin.
    """
    n = len(first)
    lens = np.arange(min(v.longest, length), 0, -1)  # longest first, so that it wins a tie
    best = np.full((n, length + 1), _NEVER)
    best[:, 0] = 0
    step = np.zeros((n, length + 1), np.int32)
    token = np.zeros((n, length + 1), np.int32)
    begin = begins[first[:, None] + np.arange(length)[None, :]]
    begin[:, 0] = True
    char = np.maximum.accumulate(np.where(begin, np.arange(length)[None, :], 0), axis=1)  # where the byte's character begins
    closed = np.ones((n, length + 1), bool)  # a character may end here
    closed[:, :length] = begin
    block = max(1, _PROBES // (n * len(lens)))
    for a in range(1, length + 1, block):
        ends = np.arange(a, min(a + block, length + 1))
        at = ends[:, None] - lens[None, :]  # start of every substring; negative: none
        start = first[:, None, None] + np.maximum(at, 0)[None]
        ids = _probe(v, roll(start, np.maximum(first[:, None, None] + ends[None, :, None], start)))
        ids[:, at < 0] = -1
        gain = np.where(ids >= 0, v.score[ids], _NEVER)
        own = (ends[None, :] - char[:, ends - 1])[:, :, None] == lens[None, None, :]  # the substring is one character
        alone = own & (ids < 0) & closed[:, ends][:, :, None]
        gain[alone] = v.unknown
        ids[alone] = -2
        for j, e in enumerate(ends.tolist()):
            total = gain[:, j] + best[:, np.maximum(at[j], 0)]
            pick = np.argmax(total, axis=1)
            rows = np.arange(n)
            best[:, e] = np.maximum(total[rows, pick], _NEVER)
            step[:, e] = lens[pick]
            token[:, e] = ids[rows, j, pick]
    out = np.full((n, length), -1, np.int32)
    place, rows = np.full(n, length), np.arange(n)
    while len(rows):
        t, size = token[rows, place], step[rows, place]
        place = place - size
        known = t >= 0
        out[rows[known], place[known]] = t[known]
        for r, p, s in zip(rows[~known].tolist(), place[~known].tolist(), size[~known].tolist()):
            out[r, p:p + s] = v.byte_id[data[first[r] + p:first[r] + p + s]]
        more = place > 0
        rows, place = rows[more], place[more]
    return out


def _placed(v: Vocabulary, data: np.ndarray, roll: RollingHash, first: np.ndarray, row: np.ndarray,
            at: np.ndarray, end: np.ndarray, length: int, n: int) -> np.ndarray:
    """The matrix of :func:`viterbi` for given symbols: word, first byte and end of each."""
    out = np.full((n, length), -1, np.int32)
    ids = _probe(v, roll(first[row] + at, first[row] + end))
    known = ids >= 0
    out[row[known], at[known]] = ids[known]
    for r, p, e in zip(row[~known].tolist(), at[~known].tolist(), end[~known].tolist()):
        out[r, p:e] = v.byte_id[data[first[r] + p:first[r] + e]]
    return out


def merge(v: Vocabulary, data: np.ndarray, roll: RollingHash, begins: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """As :func:`viterbi`, by merges: every round joins the best neighbouring pair of every word, the leftmost of equals."""
    n = len(first)
    begin = begins[first[:, None] + np.arange(length)[None, :]]
    begin[:, 0] = True
    if length > _LONG:
        return np.concatenate([_merge_long(v, data, roll, begin[i], int(first[i]), length) for i in range(n)])
    place = np.broadcast_to(np.arange(length), (n, length))
    later = np.where(begin, place, length)
    following = np.full((n, length + 1), length, np.int32)  # where the next symbol begins, for every byte
    following[:, :length - 1] = np.minimum.accumulate(later[:, ::-1], axis=1)[:, ::-1][:, 1:]
    before = np.full((n, length + 1), -1, np.int32)
    before[:, 1:] = np.maximum.accumulate(np.where(begin, place, -1), axis=1)

    def gain(row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Score of joining the symbol at ``at`` with the next one."""
        middle = following[row, at]
        ids = _probe(v, roll(first[row] + at, first[row] + following[row, middle]))
        return np.where((middle < length) & (ids >= 0), v.score[ids], _NEVER)

    score = np.full((n, length), _NEVER)
    row, at = np.nonzero(begin)
    score[row, at] = gain(row, at)
    rows = np.arange(n)
    while len(rows):
        at = np.argmax(score[rows], axis=1)
        more = score[rows, at] > _NEVER
        rows, at = rows[more], at[more]
        gone = following[rows, at]
        after = following[rows, gone]
        following[rows, at] = after
        before[rows, after] = at
        begin[rows, gone] = False
        score[rows, gone] = _NEVER
        score[rows, at] = gain(rows, at)
        left = before[rows, at]
        has = left >= 0
        score[rows[has], left[has]] = gain(rows[has], left[has])
    row, at = np.nonzero(begin)
    return _placed(v, data, roll, first, row, at, following[row, at], length, n)


def _merge_long(v: Vocabulary, data: np.ndarray, roll: RollingHash, begin: np.ndarray, first: int, length: int) -> np.ndarray:
    """One long word, by a heap of pairs."""
    at = np.flatnonzero(begin)
    following = dict(zip(at.tolist(), [*at[1:].tolist(), length]))
    before = dict(zip(at[1:].tolist(), at[:-1].tolist()))

    def pairs(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[float, int, int]]:
        ids = _probe(v, roll(first + starts, first + ends))
        good = ids >= 0
        return zip((-v.score[ids[good]]).tolist(), starts[good].tolist(), ends[good].tolist())

    heap = list(pairs(at[:-1], np.append(at[2:], length)[:len(at) - 1]))
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = following.get(i)
        if middle is None or middle >= length or following[middle] != end:
            continue  # one of the two has been joined with another symbol
        following[i] = end
        del following[middle]
        if end < length:
            before[end] = i
        near = [(i, following[end])] if end < length else []
        if i in before:
            near.append((before[i], end))
        if near:
            for pair in pairs(*map(np.array, zip(*near))):
                heapq.heappush(heap, pair)
    at = np.array(sorted(following))
    end = np.array([following[i] for i in at.tolist()])
    return _placed(v, data, roll, np.array([first]), np.zeros(len(at), np.int64), at, end, length, 1)


class Encoder:
    """Encodes slices of texts; remembers words between slices."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.key, self.check = np.zeros(0, U64), np.zeros(0, U64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, begins: np.ndarray, roll: RollingHash):
        """Tokens of words one after the other, and how many each has."""
        length = ends - starts
        counts, parts, places = np.zeros(len(starts), np.int64), [], []
        for size in np.unique(length).tolist():
            mine = np.flatnonzero(length == size)
            chunk = max(1, _TOGETHER // (size + 1))
            for a in range(0, len(mine), chunk):
                some = mine[a:a + chunk]
                ids = (merge if self.v.merges else viterbi)(self.v, data, roll, begins, starts[some], size)
                have = ids >= 0
                counts[some] = have.sum(axis=1)
                parts.append(ids[have])
                places.append(np.repeat(some, counts[some]))
        if not parts:
            return np.zeros(0, np.int32), counts
        order = np.argsort(np.concatenate(places), kind="stable")
        return np.concatenate(parts)[order], counts

    def slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one after the other, and how many each text has."""
        size = np.diff(offsets)
        filled = size > 0
        marked = np.full(len(data) + int(filled.sum()), 0x20, np.uint8)  # a space before every text
        shift = np.cumsum(filled)
        marked[np.arange(len(data)) + np.repeat(shift, size)] = data
        text_start = offsets[:-1] + shift - filled
        begins = _char_starts(marked)
        cut = np.zeros(len(marked), bool)
        cut[1:] = ~self.v.pairs[marked[:-1].astype(np.int64) * 256 + marked[1:]] & begins[1:]
        cut[text_start[filled]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(marked))
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(size), np.int64)
        roll = RollingHash(marked)
        key, check = roll(starts, ends), RollingHash(marked, 1)(starts, ends) + (ends - starts).astype(U64)
        unique, index, inverse = np.unique(key, return_index=True, return_inverse=True)
        if (check != check[index][inverse]).any():  # two words of one hash: look at both hashes together
            pair = key ^ (check * U64(BASES[0]))
            unique, index, inverse = np.unique(pair, return_index=True, return_inverse=True)
            tokens, counts = self.words(marked, starts[index], ends[index], begins, roll)
            first = np.cumsum(counts) - counts
        else:
            tokens, first, counts = self._remembered(unique, check[index], marked, starts[index], ends[index], begins, roll)
        n = counts[inverse]
        stop = np.cumsum(n)
        total = int(stop[-1])
        ids = tokens[np.arange(total) + np.repeat(first[inverse] - (stop - n), n)]
        text = np.searchsorted(text_start[filled], starts, side="right") - 1
        per = np.zeros(len(size), np.int64)
        per[filled] = np.bincount(text, weights=n, minlength=int(filled.sum())).astype(np.int64)
        return ids, per

    def _remembered(self, key, check, data, starts, ends, begins, roll):
        slot = np.minimum(np.searchsorted(self.key, key), max(0, len(self.key) - 1))
        known = (self.key[slot] == key) & (self.check[slot] == check) if len(self.key) else np.zeros(len(key), bool)
        new = np.flatnonzero(~known)
        if len(self.key) and (np.isin(key[new], self.key)).any():  # same hash, another word
            self._forget()
            return self._remembered(key, check, data, starts, ends, begins, roll)
        tokens, counts = self.words(data, starts[new], ends[new], begins, roll)
        first, count = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        if len(self.key):
            first[known], count[known] = self.first[slot[known]], self.count[slot[known]]
        base = len(self.tokens)
        all_tokens = np.concatenate([self.tokens, tokens])
        first[new], count[new] = base + np.cumsum(counts) - counts, counts
        if len(self.key) + len(new) > _REMEMBERED:
            self._forget()
        else:
            merged = np.concatenate([self.key, key[new]])
            order = np.argsort(merged)
            self.key = merged[order]
            self.check = np.concatenate([self.check, check[new]])[order]
            self.first = np.concatenate([self.first, first[new]])[order]
            self.count = np.concatenate([self.count, count[new]])[order]
            self.tokens = all_tokens
        return all_tokens, first, count


def decode(v: Vocabulary, ids: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts one after the other, and their lengths, from token ids and tokens per text."""
    size = v.bounds[ids + 1] - v.bounds[ids]
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    data = v.blob[np.arange(total) + np.repeat(v.bounds[ids] - (stop - size), size)]
    token_stop = np.concatenate([[0], np.cumsum(per)])
    byte_stop = np.concatenate([[0], stop])[token_stop]
    length = np.diff(byte_stop)
    keep = np.ones(total, bool)
    keep[byte_stop[:-1][length > 0]] = False  # the space before every text
    return data[keep], length - (length > 0)


def _lists(ids: np.ndarray, per: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``docs`` without its text, with ``token_ids``."""
    docs = docs.drop("token_ids")
    held = docs.sparkSession.sparkContext.broadcast(plain(load(path)))  # plain arrays, which workers read without this package
    at = docs.columns.index("text")
    rest = [i for i in range(len(docs.columns)) if i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*held.value))
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(at), _SLICE):
                ids, per = encoder.slice(data, offsets)
                kept = [batch.column(i).slice(first, last - first) for i in rest]
                yield pa.RecordBatch.from_arrays([*kept, _lists(ids, per)],
                                                 [*[batch.schema.names[i] for i in rest], "token_ids"])

    schema = docs.drop("text").schema.add("token_ids", T.ArrayType(T.IntegerType()))
    return docs.mapInArrow(run, schema)


def _digested(part: pa.RecordBatch, data: np.ndarray, length: np.ndarray, whole: bool) -> pa.RecordBatch:
    """``part`` with the SHA-256 of its decoded texts and, if wanted, their bytes."""
    blob, stop = data.tobytes(), np.concatenate([[0], np.cumsum(length)]).tolist()
    texts = [blob[i:j] for i, j in zip(stop, stop[1:])]
    columns = {"decoded": pa.array(texts, pa.binary())} if whole else {}
    columns["decoded_sha256"] = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
    return pa.RecordBatch.from_arrays([*part.columns, *columns.values()], [*part.schema.names, *columns])


def round_trip(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``docs`` without its text, with ``token_ids`` and the SHA-256 of what they decode to, in one pass."""
    docs = docs.drop("token_ids", "decoded_sha256")
    held = docs.sparkSession.sparkContext.broadcast(plain(load(path)))  # plain arrays, which workers read without this package
    at = docs.columns.index("text")
    rest = [i for i in range(len(docs.columns)) if i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*held.value)
        encoder = Encoder(vocabulary)
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(at), _SLICE):
                ids, per = encoder.slice(data, offsets)
                kept = [batch.column(i).slice(first, last - first) for i in rest]
                names = [batch.schema.names[i] for i in rest]
                part = pa.RecordBatch.from_arrays([*kept, _lists(ids, per)], [*names, "token_ids"])
                yield _digested(part, *decode(vocabulary, ids, per), whole=False)

    schema = docs.drop("text").schema.add("token_ids", T.ArrayType(T.IntegerType())).add("decoded_sha256", T.StringType())
    return docs.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes its ``token_ids`` stand for, and their SHA-256 in hex."""
    encoded = encoded.drop("decoded", "decoded_sha256")
    held = encoded.sparkSession.sparkContext.broadcast(plain(load(path)))  # plain arrays, which workers read without this package
    at = encoded.columns.index("token_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*held.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                lists = part.column(at)
                per = np.array([len(x) if x.is_valid else 0 for x in lists], dtype=np.int64)
                data, length = decode(vocabulary, lists.flatten().to_numpy(zero_copy_only=False), per)
                yield _digested(part, data, length, whole=True)

    schema = encoded.select("*").schema.add("decoded", T.BinaryType()).add("decoded_sha256", T.StringType())
    return encoded.mapInArrow(run, schema)


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs).selectExpr("doc_id", "cast(size(token_ids) AS long) AS n_tokens", "decoded_sha256", "token_ids")
