"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

Encoding. A text is cut into pretokens by the vocabulary's pattern; inside a pretoken the
merge list decides. Whether a token boundary stands at byte p depends only on bytes before
p + L, where L (``lookahead``) is computed from the merge list by a recurrence over merges
in rank order. So a pretoken of any length is encoded through windows of fixed size: the
tokens that end at least L bytes before the window's end are stable and are emitted, and
the next window starts there. Memory is a window and a bounded memo of short pretokens.

Decoding. Ids become bytes, and an incremental UTF-8 state machine turns bytes into text,
holding back the few bytes of an unfinished character; what never becomes a character is
written as U+FFFD.

The added token strings of the file are found in the text first and have their own ids, as
that file's library does by default.

Defined cases: a null text is the empty text (no ids); texts of any length are encoded
whole; equal texts give equal ids; an empty table gives an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice
from operator import itemgetter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from pricelake.llm.common import Memo, batch_of, releasing, text_of

#: The pretoken pattern that goes with this kind of vocabulary.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Between these two characters a pretoken always ends: a piece of text may be cut there.
SAFE_CUT = r"\S(?= )"
PIECE_CHARS = 65_536
MEMO_BYTES = 48


def byte_symbols() -> dict[str, int]:
    """The printable sign that stands for each byte in the vocabulary file: Latin-1's visible
    signs stand for themselves, the other bytes are numbered from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class MergeList:
    """Token bytes, merges by pair of ids, and the lookahead that suffices."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols, vocab = byte_symbols(), spec["model"]["vocab"]
        self.token_bytes = {i: bytes(symbols[c] for c in token) for token, i in vocab.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes |= {i: s.encode() for s, i in self.added.items()}
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.rank, self.made = {p: rank for p, (rank, _) in self.merges.items()}, [vocab[a + b] for a, b in pairs]
        self.byte_ids = [0] * 256
        for sign, b in symbols.items():
            self.byte_ids[b] = vocab[sign]
        self.lookahead = self._sufficient_lookahead()
        self.window = 4 * self.lookahead + 1024

    def _sufficient_lookahead(self) -> int:
        """Most bytes right of a boundary on which a merge across it can depend.

        A merge (u, v) needs v intact. v can be destroyed, before the merge's turn, only by
        a merge of smaller rank (x, y) whose left part x is a node of v's tree and whose
        right part y starts where x ends; that one in turn depends on ``reach`` of (x, y).
        Ranks fall along such a chain, so one pass in rank order computes every reach.
        """
        size = {i: 1 for i in self.byte_ids}
        inner = {i: 1 for i in self.byte_ids}  # bytes on which forming a token depends, from its start
        ranks: dict[int, list[int]] = {}
        reaches: dict[int, list[int]] = {}  # running maximum of reach over merges with that left part

        def stolen(x: int, before: int) -> int:
            k = bisect_left(ranks.get(x, ()), before)
            return reaches[x][k - 1] if k else 0

        most = 1
        for (left, right), (rank, made) in sorted(self.merges.items(), key=lambda m: m[1][0]):
            reach = max(inner[right], size[right] + stolen(right, rank))
            ranks.setdefault(left, []).append(rank)
            tops = reaches.setdefault(left, [])
            tops.append(max(reach, tops[-1] if tops else 0))
            most = max(most, reach)
            need = max(inner[left], size[left] + inner[right], size[left] + stolen(left, rank), size[left] + size[right] + stolen(right, rank))
            if made not in size:
                size[made], inner[made] = size[left] + size[right], need
            else:
                inner[made] = max(inner[made], need)
        return most

    def merge(self, data: bytes) -> list[int]:
        """Ids of ``data`` on its own: the pair of least rank merges first, leftmost first."""
        ids = [self.byte_ids[b] for b in data]
        if len(ids) > MEMO_BYTES:
            return self._merge_long(ids)
        rank, made, never = self.rank, self.made, len(self.made)
        ranks = [rank.get(p, never) for p in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < never:
            k = ranks.index(least)
            ids[k : k + 2] = [made[least]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank.get((ids[k - 1], ids[k]), never)
            if k < len(ranks):
                ranks[k] = rank.get((ids[k], ids[k + 1]), never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same in n log n: a heap of candidate pairs over a linked list."""
        import heapq

        n, merges = len(ids), self.merges
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(merges[p][0], k, p) for k, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            _, k, pair = heapq.heappop(heap)
            j = after[k] if alive[k] else n
            if j >= n or (ids[k], ids[j]) != pair:
                continue
            ids[k], alive[j], after[k] = merges[pair][1], False, after[j]
            if after[j] < n:
                before[after[j]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (p := (ids[a], ids[b])) in merges:
                    heapq.heappush(heap, (merges[p][0], a, p))
        return [t for t, live in zip(ids, alive) if live]

    def transduce(self, data: bytes) -> Iterator[int]:
        """Ids of one pretoken, emitted window by window as they become stable."""
        start, size = 0, self.token_bytes
        while len(data) - start > self.window:
            end = 0
            for t in self.merge(data[start : start + self.window]):
                if end + len(size[t]) > self.window - self.lookahead:
                    break
                yield t
                end += len(size[t])
            start += end
        yield from self.merge(data[start:])


class Encoder:
    """Text to ids, piece by piece.

    A pretoken's ids, their decimal text and their bytes are kept together, so that a word
    costs one look at the memo, however many ids it has.
    """

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.pretoken, self.cut = regex.compile(PRETOKEN), regex.compile(SAFE_CUT)
        self.added = regex.compile("|".join(map(regex.escape, sorted(merges.added, key=len, reverse=True)))) if merges.added else None
        self.memo = Memo(self._written, 300_000)

    def _written(self, word: str) -> tuple[tuple[int, ...], str, bytes]:
        """ids, their decimal text, and the bytes that the ids stand for."""
        ids = tuple(self.merges.merge(word.encode("utf-8", "surrogatepass")))
        return ids, ",".join(map(str, ids)), b"".join(map(self.merges.token_bytes.__getitem__, ids))

    def _pieces(self, text: str, start: int, end: int) -> Iterator[str]:
        """Pieces of whole pretokens of about PIECE_CHARS; a pretoken longer than that is one piece."""
        while end - start > PIECE_CHARS and (cut := self.cut.search(text, start + PIECE_CHARS, end)):
            yield text[start : cut.end()]
            start = cut.end()
        yield text[start:end]

    def _pretokens(self, piece: str) -> Iterator[list[str]]:
        """Lists of pretokens, of bounded length even in a piece without a safe cut."""
        if len(piece) <= 2 * PIECE_CHARS:
            yield self.pretoken.findall(piece)
            return
        few, size = [], 0
        for m in self.pretoken.finditer(piece):
            few.append(m[0])
            size += len(m[0])
            if size >= PIECE_CHARS:
                yield few
                few, size = [], 0
        yield few

    def runs(self, text: str) -> Iterator[list[tuple[tuple[int, ...], str, bytes]]]:
        """Runs of (ids, decimal text, bytes), in order; long pretokens come window by window."""
        start = 0
        for m in self.added.finditer(text) if self.added else ():
            yield from self._ordinary(text, start, m.start())
            i = self.merges.added[m[0]]
            yield [((i,), str(i), self.merges.token_bytes[i])]
            start = m.end()
        yield from self._ordinary(text, start, len(text))

    def _ordinary(self, text: str, start: int, end: int) -> Iterator[list[tuple[tuple[int, ...], str, bytes]]]:
        memo = self.memo
        for piece in self._pieces(text, start, end) if end > start else ():
            for words in self._pretokens(piece):
                if len(piece) <= 8 * len(words) or max(map(len, words), default=0) <= MEMO_BYTES:
                    yield list(map(memo.__getitem__, words))
                    continue
                for word in words:  # long pretokens go past the memo, which keeps its size bounded
                    yield from [[memo[word]]] if len(word) <= MEMO_BYTES else self._long(word)

    def _long(self, word: str) -> Iterator[list[tuple[tuple[int, ...], str, bytes]]]:
        ids, size = self.merges.transduce(word.encode("utf-8", "surrogatepass")), self.merges.token_bytes
        while few := tuple(islice(ids, 4096)):
            yield [(few, ",".join(map(str, few)), b"".join(map(size.__getitem__, few)))]

    def encode(self, text: str) -> Iterator[list[int]]:
        """Runs of ids, in order."""
        for run in self.runs(text):
            yield list(chain.from_iterable(map(itemgetter(0), run)))


class Decoder:
    """Ids to text; a state machine over bytes that keeps unfinished characters for later."""

    def __init__(self, merges: MergeList):
        self.token_bytes, self.machine = merges.token_bytes, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int], last: bool = False) -> str:
        return self.feed_bytes(b"".join(map(self.token_bytes.__getitem__, ids)), last)

    def feed_bytes(self, data: bytes, last: bool = False) -> str:
        return self.machine.decode(data, last)


@lru_cache(maxsize=2)
def merge_list(path: str) -> MergeList:
    return MergeList(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(merge_list(path))


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
DECODED = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
ROUND_TRIP = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and ids of every whole text. ``vocabulary``: path of the file on every executor."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        for batch in batches:
            ids = [list(chain.from_iterable(code.encode(text_of(t)))) for t in batch["text"].to_pylist()]
            yield batch_of(ENCODED, batch["doc_id"], ids)

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and text of every row of ids; null ids give the empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of(DECODED, batch["doc_id"], [Decoder(merge_list(vocabulary)).feed(ids or (), True) for ids in batch["ids"].to_pylist()])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encodes and decodes in one pass and returns digests: a run of ids goes from the
    encoder to the id digest and to the decoder, whose text goes to the text digest, so
    neither a document's ids nor its decoded text is ever whole in memory."""

    @releasing
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        for batch in batches:
            out: list[tuple[int, str, str]] = []
            for text in batch["text"]:
                n, ids_hash, text_hash, back = 0, hashlib.sha256(), hashlib.sha256(), Decoder(code.merges)
                for run in code.runs(text_of(text.as_py())):
                    ids, written, data = zip(*run)
                    ids_hash.update((("," if n else "") + ",".join(written)).encode())
                    text_hash.update(back.feed_bytes(b"".join(data)).encode())
                    n += sum(map(len, ids))
                text_hash.update(back.feed((), True).encode())
                out.append((n, ids_hash.hexdigest(), text_hash.hexdigest()))
            yield batch_of(ROUND_TRIP, batch["doc_id"], *(zip(*out) if out else ([], [], [])))
        code.memo.clear()  # a worker outlives the task

    return docs.select("doc_id", "text").mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path())
