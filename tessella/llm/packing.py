"""Operator 7: packing by the dot-product heuristic for vector bin packing.

An example is a vector (tokens, segments, loss-bearing tokens), a sequence a bin with a limit in each. The
open bin takes, of the waiting examples that fit, the one whose vector has the largest dot product with the
bin's remaining room (each dimension weighed by its limit), so that the dimension with most room left is
filled first. An example that fits nowhere is cut where the open bin is full in one dimension, and full-length
pieces make sequences by themselves.

Of instruction data (``answer_col``) the tokens of the answer and the end bear loss, those of the prompt do not;
``loss`` limits them in each sequence, and where it binds it is the limit that cuts. Of plain texts every token
bears loss, and with the default limit of a whole sequence the third dimension equals the first.

Every task packs what it reads: no shuffle, at most ``WAITING`` examples in memory, one encoder for each worker
process. What is left at a task's end is cut into sequences whose lengths are powers of two, which need no padding.

Tokens come from a public byte-level BPE file (a parameter). Texts in Latin-1 go through a faster encoder
over the same vocabulary, given as ranks; for others the ids of blank-delimited pieces are remembered, and a
text in which white space could be grouped across such pieces, or that spells a special token, is encoded as
a whole by the tokenizer. All ways give the tokenizer's own ids.

Defined cases: a null text counts as empty and consists of the end id alone; repeated rows, and rows that share an
id or have none, are packed each (their pieces carry equal ids); an empty table gives no piece; other columns are
ignored.
"""

from __future__ import annotations

import base64
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import lean, table

LENGTH, SEGMENTS, LOSS = 2048, 512, 2048
END_ID = 1
WAITING = 256
CACHE = 200_000
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: White space that holds two blanks or more: its grouping depends on more than one blank-delimited piece.
_TANGLED = re.compile(r" \s* ")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _latin1(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _latin_encoder(ranks_path: str):
    """str -> ids by the same vocabulary, given as ranks."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def special_tokens(path: str) -> list[str]:
    """The tokens of the file that are not spelled by its merges; the vocabulary must have ids of 16 bits."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
        raise ValueError("ids must fit in 16 bits")
    return sorted(t.content for t in tokenizer.get_added_tokens_decoder().values())


class Encoder(dict):
    """Text -> ids as uint16, remembering pieces. The tokenizer and the ranks are read when a text first needs them."""

    def __init__(self, path: str, ranks_path: str | None, special: list[str]):
        super().__init__()
        self.path, self.ranks_path, self.special = path, ranks_path, special

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @cached_property
    def latin(self):
        return _latin_encoder(self.ranks_path) if self.ranks_path else None

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.whole(piece)
        if len(self) >= CACHE:
            self.clear()
        if len(piece) < 64:
            self[piece] = ids
        return ids

    def ids(self, text: str | None, end_id: int | None = END_ID) -> np.ndarray:
        if not text:
            raw = b""
        elif self.ranks_path and _latin1(text) and not any(s in text for s in self.special):
            raw = array("H", self.latin(text)).tobytes()
        elif _TANGLED.search(text) or any(s in text for s in self.special):
            raw = self.whole(text)
        else:
            first, *rest = text.split(" ")
            raw = (self[first] if first else b"") + b"".join([self[" " + x] for x in rest])
        return np.frombuffer(raw + (np.array([end_id], "<u2").tobytes() if end_id is not None else b""), "<u2")


@lru_cache(maxsize=2)
def encoder_of(path: str, ranks_path: str | None, special: tuple[str, ...]) -> Encoder:
    """One for each worker process, whatever the number of its tasks."""
    return Encoder(path, ranks_path, list(special))


class Packer:
    """Fills one open bin after another. Examples are (tokens, loss tokens, key), the loss tokens last; pieces come out as (key, start, length, bin, offset)."""

    def __init__(self, length: int = LENGTH, segments: int = SEGMENTS, loss: int = LOSS, waiting: int = WAITING, cut: bool = True):
        if min(length, segments, loss) < 1:
            raise ValueError("limits must be positive")
        self.limit, self.waiting, self.cut = np.array([length, segments, loss], float), waiting, cut
        self.length = length
        self.size = np.zeros((waiting, 3))
        self.item: list = [None] * waiting
        self.free = list(range(waiting))[::-1]
        self.bin, self.used = 0, np.zeros(3)

    def _close(self) -> None:
        self.bin, self.used = self.bin + 1, np.zeros(3)

    def _place(self, key, start: int, n: int, loss: float) -> tuple:
        piece = (key, start, n, self.bin, int(self.used[0]))
        self.used += (n, 1, loss)
        if (self.used >= self.limit)[:2].any():
            self._close()
        return piece

    def add(self, tokens: int, loss: int, key) -> Iterator[tuple]:
        """Takes an example; yields the pieces that are placed on the way."""
        start, free = 0, tokens - loss
        if self.cut:
            while tokens - start >= self.length:
                n = self.length - int(self.used[0])
                bears = max(0, start + n - max(start, free))
                if (self.used + (n, 1, bears) > self.limit).any():
                    break  # it waits, and is cut where its loss tokens fill a bin
                yield self._place(key, start, n, bears)
                start += n
            if start == tokens:
                return
        elif tokens > self.length or loss > self.limit[2]:
            raise ValueError("an example that may not be cut is over the limits")
        slot = self.free.pop()
        self.size[slot] = (tokens - start, 1, min(loss, tokens - start))
        self.item[slot] = (key, start)
        while not self.free:
            yield from self._step()

    def _step(self) -> Iterator[tuple]:
        """Places the waiting example that suits the open bin best; or cuts one to fill it; or closes it."""
        room = self.limit - self.used
        held = self.size[:, 0] > 0
        fits = held & (self.size <= room).all(1)
        if fits.any():
            worth = (self.size / self.limit) @ (room / self.limit)
            slot = int(np.where(fits, worth, -1).argmax())
            yield self._take(slot, int(self.size[slot, 0]))
            return
        if self.cut and room[0] >= 1 and room[1] >= 1:
            # of each, the tokens up to the end of the bin, or to the last loss token it has room for
            most = np.where(held, np.minimum(room[0], self.size[:, 0] - self.size[:, 2] + room[2]), 0)
            most = np.minimum(most, self.size[:, 0])
            slot = int(np.lexsort((self.size[:, 0], most))[-1])
            if most[slot] >= 1 and (most[slot] == room[0] or not self.used[0] or room[2] < 1):
                yield self._take(slot, int(most[slot]))
                return
        self._close()

    def _take(self, slot: int, n: int) -> tuple:
        (key, start), (tokens, _, loss) = self.item[slot], self.size[slot]
        bears = max(0.0, n - (tokens - loss))
        if n == tokens:
            self.size[slot], self.item[slot] = 0, None
            self.free.append(slot)
        else:
            self.size[slot] -= (n, 0, bears)
            self.item[slot] = (key, start + n)
        return self._place(key, start, n, bears)

    def finish(self) -> Iterator[tuple]:
        """Places all that waits; the last bin, if it may be cut, falls into sequences with powers of two as lengths."""
        last: list[tuple] = []
        while len(self.free) < self.waiting:
            for piece in self._step():
                if last and piece[3] != last[0][3]:
                    yield from last
                    last = []
                last.append(piece)
        full = last and (sum(p[2] for p in last) == self.length or not self.cut)
        if full or not last:
            yield from last
            return
        rest, at = [list(p) for p in last], last[0][3]
        total = sum(p[2] for p in rest)
        for power in reversed(range(self.length.bit_length())):
            if not total & (1 << power):
                continue
            left, offset = 1 << power, 0
            while left:
                key, start, n, _, _ = rest[0]
                part = min(n, left)
                yield (key, start, part, at, offset)
                offset, left = offset + part, left - part
                if part == n:
                    rest.pop(0)
                else:
                    rest[0][1:3] = [start + part, n - part]
            at += 1
        self.bin = at


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Pieces that are handed over at once.
STEP = 2048


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, length: int = LENGTH, segments: int = SEGMENTS, loss: int = LOSS, with_ids: bool = False, answer_col: str | None = None) -> DataFrame:
    """The pieces of all documents. sequence_id is unique over all tasks: the task's number and the bin's.

    With answer_col, text_col is a prompt and a row the prompt, the answer and the end; loss_tokens says how many of a
    piece's tokens are the answer's or the end.
    """
    name, ranks = path or tokenizer_path(), None if path or sys.byteorder != "little" else tokenizer_path(RANKS)
    special = tuple(special_tokens(name))
    schema = PIECES + (", loss_tokens long" if answer_col else "") + (", ids array<int>" if with_ids else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = encoder_of(name, ranks, special), Packer(length, segments, loss)
        task = TaskContext.get().partitionId() << 32

        def row(piece: tuple) -> tuple:
            (doc, ids, free), start, n, number, offset = piece
            own = ids[start : start + n]
            fields = [doc, start, n, zlib.crc32(own.astype("<u4").tobytes()), len(ids), task + number, offset]
            if answer_col:
                fields.append(max(0, start + n - max(start, free)))
            return (*fields, own.astype(np.int32)) if with_ids else tuple(fields)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int32()) if k == "ids" else pa.int64()) for k, c in zip(names, columns, strict=True)], names=names)

        out: list[tuple] = []
        for batch in batches:
            for fields in zip(*batch.columns, strict=True):  # one text at a time
                doc, text = fields[0].as_py(), fields[1].as_py()
                if answer_col:
                    prompt = encoder.ids(text, None)
                    ids = np.concatenate([prompt, encoder.ids(fields[2].as_py())])
                    free = len(prompt)
                else:
                    ids, free = encoder.ids(text), 0
                out.extend(map(row, packer.add(len(ids), len(ids) - free, (doc, ids, free))))
                if len(out) >= STEP:
                    yield batch_of(out)
                    out = []
        out.extend(map(row, packer.finish()))
        yield batch_of(out)

    return docs.select(id_col, text_col, *([answer_col] if answer_col else [])).mapInArrow(lean(run), schema)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
