"""Operator 3: token ids in a binary file, by static range asymmetric numeral systems (rANS).

Documents are sorted by doc_id over range partitions and tokenised there; ids are kept in raw
blocks of whole documents. The counts of all ids of all blocks give one shared frequency table.
Each block is then coded on its own: its ids are dealt in turn to interleaved 64-bit states
that share one stream of 32-bit words, so encoder and decoder work on all states at a step. A block
holds its document lengths, checkpoints (word position and states at some steps, where a
reader can start) and a checksum of its ids. Blocks are rows of a Parquet table written to the
shared folder, and are decoded in any order and on any machine.

Block layout, little endian: magic `SRA1`; u32 lanes, ids, documents, words, checkpoints, crc32 of
the ids as u32, scale bits, step between checkpoints; u32 length of each document; u64 state of
each lane; for each checkpoint u32 word position and u64 states; u32 words.

Nulls: a null text is empty and has the end id only; null doc_ids come first. Empty texts have
the end id only, and tables without rows give an empty file and result. Repeated rows and
repeated doc_ids are documents of their own, ordered by their text's hash. Long texts are
tokenised whole and make a block of their own. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, ensure, kept, lean, materialize, new_path, slices_of

END, BLOCK, LANES, SCALE, STEP = 2, 1 << 18, 1024, 18, 128
MAGIC = b"SRA1"
#: Pieces whose ids a worker remembers, besides as many that it met before them.
REMEMBER = 1 << 18
#: A lower-case word with marks after it, which the tokenizer takes apart; apostrophes may bind.
MARKED = re.compile(r"([a-z]+)([!-&(-/:-@\[-`{-~]+)")
#: The same with the letters of Latin-1, each of which has one lower-case form and is composed already.
LATIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: What stands for each letter of Latin-1 beyond ASCII in a byte-level model: a character for each of its bytes.
_OWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTES = {b: chr(b) for b in _OWN} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _OWN)}
SHOWN = {c: "".join(_BYTES[b] for b in chr(c).encode()) for c in range(128, 256)}


class Words(dict):
    """Ids of pieces between spaces and line feeds, which the tokenizer never joins, as bytes."""

    def __init__(self, file: str, kind: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.old: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(file)
        self.model = None
        steps = json.loads(self.tokenizer.to_str())
        kinds = [[x["type"] for x in ((steps[name] or {}).get(own) or [])] for name, own in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        if kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] and not steps["pre_tokenizer"]["pretokenizers"][1]["add_prefix_space"]:
            # These steps leave a lower-case word of Latin-1 letters as it is, so such words go to the model at once.
            self.model = self.tokenizer.model
        self.form = (MARKED if self.model is None else LATIN).fullmatch
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.use(kind)

    def use(self, kind: str) -> None:
        self.kind, self.code = kind, "H" if kind == "<u2" else "I"

    def cut(self, text: str | None) -> list[str]:
        """Pieces of a text. The tokenizer lower-cases; doing so for Latin-1 first makes fewer of them.

        Pieces with other characters keep their case: the tokenizer composes marks before it lower-cases.
        A text that may spell a special token keeps its case too, for that decides what it is.
        """
        text = text or ""
        if "<|" in text:
            return text.replace("\n", " ").split(" ")
        if text.isascii() or self.model is not None and is_latin(text):
            return text.lower().replace("\n", " ").split(" ")
        return [x.lower() if x.isascii() else x for x in text.replace("\n", " ").split(" ")]

    def make_room(self) -> None:
        if len(self) > REMEMBER:
            self.old = dict(self)
            self.clear()

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.found(piece)
        self[piece] = ids
        return ids

    def found(self, piece: str) -> bytes:
        """Ids of a piece that is not remembered; those of a word and of marks after it are sought on their own."""
        match = self.form(piece)
        if match is not None:
            word, marks = match.groups()
            if marks:
                return self[word.lower()] + self[marks]
            if (word := word.lower()) != piece:
                return self[word]
            if self.model is not None:
                if not word.isascii():
                    word = word.translate(SHOWN)
                return array(self.code, [x.id for x in self.model.tokenize(word)]).tobytes()
        return array(self.code, self.tokenizer.encode_batch_fast([piece], add_special_tokens=False)[0].ids).tobytes()

    def learn(self, lists: list[list[str]]) -> None:
        self.make_room()
        for pieces in lists:
            for piece in pieces:
                self[piece]

    def encoded(self, text: str | None) -> bytes:
        """Ids of a text; each piece is looked up once."""
        self.make_room()
        return b"".join(map(self.__getitem__, self.cut(text)))


def is_latin(text: str) -> bool:
    """Whether all characters are of Latin-1, which are composed and have one lower-case form each."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def words_of(file: str) -> Words:
    """This process's pieces of a tokenizer; tasks of this operator that a worker runs one after another share them."""
    if (file, "words") not in kept():
        words = Words(file, "<u4")
        if words.vocabulary <= 1 << 16:
            words.use("<u2")
        kept()[file, "words"] = words
    return kept()[file, "words"]


def tokenised(docs: DataFrame, file: str, partitions: int, end: int = END, block: int = BLOCK) -> DataFrame:
    """Raw blocks (part, block, doc_ids, lengths, ids) in the order of doc_id, and each part's counts."""
    rows = ensure(docs, doc_id="long", text="string")
    rows = rows.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        words = words_of(file)
        vocabulary, kind = max(words.vocabulary, end + 1), words.kind
        last = np.array([end], kind).tobytes()
        counts = np.zeros(vocabulary, np.int64)
        ids, held, lengths, size = [], [], [], 0

        def flush():
            nonlocal ids, held, lengths, size, at
            raw = b"".join(ids)
            counts[:] += np.bincount(np.frombuffer(raw, kind), minlength=vocabulary)
            row = ([part], [at], [held], [lengths], [raw], [np.dtype(kind).itemsize], [None])
            ids, held, lengths, size, at = [], [], [], 0, at + 1
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, kinds, strict=True)], names=names)

        names = ["part", "block", "doc_ids", "lengths", "ids", "width", "counts"]
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.binary()]
        for some in slices_of(batches, 64):
            for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist(), strict=True):
                raw = words.encoded(text) + last
                n = len(raw) // np.dtype(kind).itemsize
                if size and size + n > block:
                    yield flush()
                ids.append(raw), held.append(doc_id), lengths.append(n)
                size += n
        if held:
            yield flush()
        if at:
            row = ([part], [-1], [None], [None], [None], [None], [counts.tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, kinds, strict=True)], names=names)

    return rows.mapInArrow(lean(run, keeps=True), "part int, block int, doc_ids array<long>, lengths array<long>, ids binary, width int, counts binary")


def shares(counts, scale: int = SCALE):
    """Counts to whole frequencies that add up to 2**scale, at least 1 for every id that occurs."""
    import numpy as np

    counts = np.asarray(counts, np.int64)
    out, total = np.zeros(len(counts), np.int64), 1 << scale
    there = np.flatnonzero(counts)
    if not len(there):
        return out.astype(np.uint32)
    if len(there) > total:
        raise ValueError("more ids than the table has places")
    out[there] = np.maximum(1, (counts[there].astype(object) * total // int(counts.sum())).astype(np.int64))
    gap = total - int(out.sum())
    if gap > 0:
        out[there[np.argmax(counts[there])]] += gap
    order = there[np.argsort(-out[there], kind="stable")]
    while gap < 0:  # the largest give what the smallest were lifted by
        for k in order:
            give = min(-gap, int(out[k]) // 8 if out[k] >= 16 else int(out[k]) - 1)
            out[k] -= give
            gap += give
            if gap == 0:
                break
    return out.astype(np.uint32)


class Coder:
    def __init__(self, freqs, scale: int = SCALE):
        import numpy as np

        self.scale, self.f = scale, np.asarray(freqs, np.uint64)
        self.c = np.concatenate([[0], np.cumsum(self.f)[:-1]]).astype(np.uint64)
        self.at = None
        self.limit = (np.uint64(1 << 31) >> np.uint64(scale) << np.uint64(32)) * self.f

    def encode(self, ids, lengths, lanes: int = LANES, step: int = STEP) -> bytes:
        import numpy as np

        ids = np.asarray(ids, np.uint32)
        n = len(ids)
        lanes = max(1, min(lanes, n // 64))
        steps = -(-n // lanes)
        x = np.full(lanes, 1 << 31, np.uint64)
        out, marks, written = [], [], 0
        low, s32, bits = np.uint64(0xFFFFFFFF), np.uint64(32), np.uint64(self.scale)
        for t in range(steps - 1, -1, -1):
            own = ids[t * lanes : (t + 1) * lanes]
            f, c, limit = self.f[own], self.c[own], self.limit[own]
            y = x[: len(own)]
            over = y >= limit
            if over.any():
                out.append((y[over] & low).astype("<u4"))
                written += len(out[-1])
                y = np.where(over, y >> s32, y)
            q = y // f
            x[: len(own)] = (q << bits) + (y - q * f) + c
            if t and t % step == 0:
                marks.append((written, x.copy()))
        words = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
        marks = [(written - w, state) for w, state in marks[::-1]]
        head = struct.pack("<4s8I", MAGIC, lanes, n, len(lengths), len(words), len(marks), zlib.crc32(ids.astype("<u4").tobytes()), self.scale, step)
        body = [head, np.asarray(lengths, "<u4").tobytes(), x.astype("<u8").tobytes()]
        for position, state in marks:
            body += [struct.pack("<I", position), state.astype("<u8").tobytes()]
        return b"".join([*body, words.astype("<u4").tobytes()])

    def decode(self, block: bytes, checkpoint: int = 0):
        """(ids, lengths) of a block; from a checkpoint k > 0 on, the ids from step k * STEP on."""
        import numpy as np

        magic, lanes, n, docs, n_words, n_marks, crc, scale, step = struct.unpack_from("<4s8I", block)
        if magic != MAGIC or scale != self.scale:
            raise ValueError("not a block of this file")
        pos = struct.calcsize("<4s8I")
        lengths = np.frombuffer(block, "<u4", docs, pos)
        pos += 4 * docs
        x = np.frombuffer(block, "<u8", lanes, pos).copy()
        pos += 8 * lanes
        at = 0
        if checkpoint:
            place = pos + (checkpoint - 1) * (4 + 8 * lanes)
            at = struct.unpack_from("<I", block, place)[0]
            x = np.frombuffer(block, "<u8", lanes, place + 4).copy()
        pos += n_marks * (4 + 8 * lanes)
        words = np.frombuffer(block, "<u4", n_words, pos).astype(np.uint64)
        if self.at is None:
            self.at = np.repeat(np.arange(len(self.f), dtype=np.uint32), self.f.astype(np.int64))
        mask, bits, low, s32 = np.uint64((1 << self.scale) - 1), np.uint64(self.scale), np.uint64(1 << 31), np.uint64(32)
        out = np.empty(n - checkpoint * step * lanes, np.uint32)
        for t in range(checkpoint * step, -(-n // lanes)):
            m = min(lanes, n - t * lanes)
            y = x[:m]
            slot = y & mask
            own = self.at[slot]
            y = self.f[own] * (y >> bits) + slot - self.c[own]
            need = np.flatnonzero(y < low)
            if len(need):
                y[need] = (y[need] << s32) | words[at : at + len(need)]
                at += len(need)
            x[:m] = y
            place = (t - checkpoint * step) * lanes
            out[place : place + m] = own
        if not checkpoint and zlib.crc32(out.astype("<u4").tobytes()) != crc:
            raise ValueError("checksum differs")
        return out, lengths


def write(docs: DataFrame, path: str, file: str, partitions: int | None = None, block: int = BLOCK) -> None:
    """Encode docs into a file at path: `blocks`, and `table` with the shared frequencies."""
    import numpy as np

    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = materialize(tokenised(docs, file, partitions, block=block), "ids", compression="zstd")
    # The counts of all parts are added up by id before one row an id, a vocabulary, is fetched.
    counted = raw.where("block = -1").select("counts")

    def add(batches):
        import pandas as pd

        total = None
        for batch in batches:
            for x in batch["counts"]:
                x = np.frombuffer(x, np.int64)
                total = x if total is None else total + x
        if total is not None:
            there = np.flatnonzero(total)
            yield pd.DataFrame({"id": there, "n": total[there]})

    counts = counted.mapInPandas(add, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    known = counts.collect()
    table = np.zeros(max([r.id for r in known], default=0) + 1, np.int64)
    for r in known:
        table[r.id] = r.n
    freqs = shares(table)
    spark.createDataFrame([(bytearray(freqs.astype("<u4").tobytes()), SCALE)], "freqs binary, scale int").write.parquet(f"{path}/table")
    sent = spark.sparkContext.broadcast(freqs)

    def encode(batches):
        import pyarrow as pa

        coder = Coder(sent.value)
        for batch in slices_of(batches, 8):
            rows = batch.to_pylist()
            out = [coder.encode(np.frombuffer(r["ids"], f"<u{r['width']}"), r["lengths"]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("block"), batch.column("doc_ids"), pa.array([sum(r["lengths"]) for r in rows], pa.int64()), pa.array(out, pa.binary())],
                names=["part", "block", "doc_ids", "n_ids", "payload"],
            )

    blocks = raw.where("block >= 0").select("part", "block", "doc_ids", "lengths", "ids", "width")
    blocks.mapInArrow(lean(encode, keeps=True), "part int, block int, doc_ids array<long>, n_ids long, payload binary").write.option("compression", "none").parquet(f"{path}/blocks")
    drop(raw)


def read(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the file at path."""
    import numpy as np

    head = spark.read.schema("freqs binary, scale int").parquet(f"{path}/table").first()
    sent = spark.sparkContext.broadcast(np.frombuffer(bytes(head.freqs), "<u4"))
    blocks = spark.read.schema("part int, block int, doc_ids array<long>, n_ids long, payload binary").parquet(f"{path}/blocks")
    # One row a part and a block, no ids: what comes before each.
    sizes = sorted(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    from pyspark.sql import Window

    inside = blocks.select("part", "block", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids")).alias("inside"))
    starts = inside.join(spark.createDataFrame(before, "part int, before long"), "part").select("part", "block", (F.col("before") + F.col("inside")).alias("start"))
    placed = blocks.select("part", "block", "doc_ids", "payload").join(starts, ["part", "block"])

    def decode(batches):
        import pyarrow as pa

        coder = Coder(sent.value)
        for batch in slices_of(batches, 8):
            for r in batch.to_pylist():
                ids, lengths = coder.decode(r["payload"])
                raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths.astype(np.int64))
                begins = ends - lengths
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(begins + r["start"], pa.int64()), pa.array(lengths.astype(np.int64), pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return placed.select("doc_ids", "payload", "start").mapInArrow(lean(decode, keeps=True), "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode(docs: DataFrame, file: str, path: str | None = None) -> DataFrame:
    """Write docs to a token file (in the shared folder unless told) and read it back."""
    path = path or new_path(docs.sparkSession, "tokens")
    write(docs, path, file)
    return read(docs.sparkSession, path)
