"""Token ids in a compact binary format, written and read in parallel.

Ids are replaced by their rank by frequency over the whole input, so common ids become small numbers. A number takes one
to four whole bytes; the byte counts of four numbers share a control byte, and control bytes stand apart from the data.
A file holds documents in order, each as

    doc_id int64, flags u8 (1: doc_id is null), number of ids u32, bytes of data u32, control bytes, data bytes

(little-endian). The folder also has one file ``ranks``: the ids as u32, most frequent first. Readers take names from the
returned manifest, so files of failed or repeated tasks are never read.
"""

from __future__ import annotations

import os
import struct
import sys
import uuid
import zlib
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from icelens.llm.common import new_folder, opened, text_of
from icelens.session import settle

HEAD = "<qBII"
END = 2
CACHED_WORDS = 500_000
#: Bytes of text whose words are told apart at once: the more, the fewer words pass through Python twice, and the more memory it takes.
BYTES_AT_ONCE = 4_000_000
TEXTS_AT_ONCE = 1000
#: Stands for the ids of a word whose text must be encoded whole (never the ids of a word: these are of even length).
WHOLE = b"?"


class Encoder:
    """Texts to ids with a byte-level BPE file of the tokenizers library, word by word where that is the same.

    The pattern of byte-level BPE never lets a pre-token cross a single space between two characters that are not white
    space, so what stands between such spaces can be encoded alone and remembered. A text with other spaces is encoded
    whole. Unknown words are encoded together in long lines and cut apart at the tokens that begin with a space.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.opens = np.array([t.startswith("Ġ") for t in tokens])
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, dtype=self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        if len(self.words) > CACHED_WORDS:  # words of the generation before last are forgotten
            self.older, self.words = self.words, {}
        kept = [w for w in words if w in self.older]
        self.words.update(zip(kept, map(self.older.__getitem__, kept)))
        words = [w for w in words if w not in self.words]
        clean = []
        for word in words:
            if not word or word[0].isspace() or word[-1].isspace() or "᠎" in word:
                self.words[word] = WHOLE  # the spaces around it are not single
            else:
                clean.append(word)
        lines = [clean[i:i + 200] for i in range(0, len(clean), 200)]
        for line, ids in zip(lines, self._ids(["".join(" " + w for w in line) for line in lines])):
            at = np.flatnonzero(self.opens[ids])
            if len(at) != len(line):
                self.words.update((w, i.tobytes()) for w, i in zip(line, self._ids([" " + w for w in line])))
                continue
            data, cuts = ids.tobytes(), [*(at * self.kind.itemsize).tolist(), ids.nbytes]
            self.words.update((w, data[a:b]) for w, a, b in zip(line, cuts, cuts[1:]))

    def _heads(self, heads: list[str]) -> list[bytes]:
        if len(self.first) > CACHED_WORDS:
            self.first.clear()
        new = list({h for h in heads if h not in self.first})
        self.first.update((h, i.tobytes()) for h, i in zip(new, self._ids(new)))
        return [self.first[h] for h in heads]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cuts): the ids of all texts one after the other, and where each text begins and the last one ends.

        Only distinct words pass through Python; the ids of all words are then gathered at once.
        """
        lists = pc.split_pattern(texts, pattern=" ")
        begins = lists.offsets.to_numpy().astype(np.int64)
        words = lists.values.slice(begins[0], begins[-1] - begins[0]).dictionary_encode()
        begins = begins - begins[0]
        codes, names = words.indices.to_numpy(), words.dictionary.to_pylist()
        found = list(map(self.words.get, names))
        self._learn([w for w, ids in zip(names, found) if ids is None])
        found = [self.words[w] if ids is None else ids for w, ids in zip(names, found)]
        heads = [names[c] for c in codes[begins[:-1]].tolist()]
        marked = np.fromiter((ids == WHOLE for ids in found), dtype=bool, count=len(found))
        pieces = [b"" if ids == WHOLE else ids for ids in found] + self._heads(heads)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        starts = np.cumsum(sizes) - sizes
        # a text with a word that must not be encoded alone, or with spaces around its first word, is encoded whole
        whole = marked[codes].astype(np.int64)
        whole[begins[:-1]] = 0  # the first word is taken as it is
        odd = np.add.reduceat(whole, begins[:-1]) > 0 if len(heads) else np.zeros(0, dtype=bool)
        odd |= np.array([n > 1 and (not h or h[-1].isspace()) for h, n in zip(heads, np.diff(begins).tolist())], dtype=bool)
        at = codes.copy()
        at[begins[:-1]] = len(found) + np.arange(len(heads))
        flat, width = b"".join(pieces), self.kind.itemsize
        store = np.frombuffer(flat, dtype=self.kind)
        small = np.int32 if len(flat) + texts.nbytes < 1 << 28 else np.int64  # an id stands for a byte of text or more
        n = (sizes // width).astype(small)[at]
        ends = np.cumsum(n, dtype=small)
        places = np.repeat((starts // width).astype(small)[at] - (ends - n), n)
        places += np.arange(len(places), dtype=small)
        ids = store[places]
        cuts = np.concatenate([[0], ends])[begins].astype(np.int64)
        if not odd.any():
            return ids, cuts
        parts = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        for i in np.flatnonzero(odd).tolist():
            parts[i] = self._ids([texts[i].as_py()])[0]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


def worker_encoder(path: str) -> Encoder:
    """The encoder of this worker process, kept from task to task with the words it knows. (Functions come to a worker by
    value, so a global of this module would be new in every task.)"""
    kept = sys.modules.setdefault("_icelens_encoders", ModuleType("_icelens_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def pack(numbers: np.ndarray, cuts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """(control bytes, data bytes) of each run of ``numbers`` (below 2 ** 32) between neighbouring ``cuts``."""
    wide = numbers.astype("<u4")
    extra = (wide > 0xFF).astype(np.uint8) + (wide > 0xFFFF) + (wide > 0xFFFFFF)
    data = wide.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(extra, dtype=np.int64)])[cuts] + cuts
    # every run begins a control byte of its own
    sizes = -(-np.diff(cuts) // 4)
    starts = np.cumsum(sizes) - sizes
    codes = np.zeros(4 * int(sizes.sum()), dtype=np.uint8)
    codes[np.arange(len(wide)) + np.repeat(4 * starts - cuts[:-1], np.diff(cuts))] = extra
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8).tobytes()
    return ([control[a:a + n] for a, n in zip(starts.tolist(), sizes.tolist())],
            [data[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())])


#: For each control byte the bytes that its four numbers take.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
#: For each number of bytes the part of a four-byte word that counts.
PARTS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def unpack(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The numbers of several runs again, ``counts`` of them in each; every run began a control byte of its own."""
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)
    room = -(-counts // 4) * 4
    if (room != counts).any():  # the places that end a run's last control byte stand for nothing
        place = np.arange(len(lengths)) - np.repeat(np.cumsum(room) - room, room)
        lengths = lengths[place < np.repeat(counts, room)]
    if not len(lengths):
        return np.zeros(0, dtype=np.uint32)
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    padded = np.frombuffer(data + b"\0\0\0", dtype=np.uint8).astype(np.uint32)
    words = padded[starts] | padded[starts + 1] << 8 | padded[starts + 2] << 16 | padded[starts + 3] << 24
    return words & PARTS[lengths]


def _parts(batch: pa.RecordBatch, column: str, size: int):
    """The batch in slices of at most ``size`` bytes of a string column, or one longer string."""
    offsets = np.frombuffer(batch.column(column).buffers()[1], dtype=np.int32)[batch.column(column).offset:][:batch.num_rows + 1] if batch.num_rows else []
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(offsets, int(offsets[at]) + size, side="right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop


def encoded(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids binary, used): the ids of every whole text and END, two bytes an id (four for vocabularies over 65,536).

    At the end of a task, rows with a ``used`` (two numbers: an id and how often the task had it) and nothing else.
    """
    used = pa.list_(pa.int64())

    def encode(batches):
        encoder = worker_encoder(tokenizer)
        seen = np.zeros(len(encoder.opens), dtype=np.int64)
        for batch in batches:
            for part in _parts(batch, "text", BYTES_AT_ONCE):
                ids, cuts = encoder.encode(part.column("text"))
                ids = np.insert(ids, cuts[1:], END)
                cuts = (cuts + np.arange(len(cuts))) * encoder.kind.itemsize
                seen += np.bincount(ids, minlength=len(seen))
                data = pa.Array.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), data.cast(pa.binary()), pa.nulls(part.num_rows, used)], ["doc_id", "ids", "used"])
        found = np.flatnonzero(seen)
        for at in range(0, len(found), 10_000):
            some = found[at:at + 10_000]
            pairs = pa.array(np.stack([some, seen[some]], axis=1).tolist(), used)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.binary()), pairs], ["doc_id", "ids", "used"])

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(
        encode, "doc_id long, ids binary, used array<long>")


def _flat(values: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary array one after the other, and where each value begins and the last one ends."""
    values = values.cast(pa.large_binary())
    cuts = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset:values.offset + len(values) + 1]
    data = values.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[cuts[0]:cuts[-1]] if data else np.zeros(0, dtype=np.uint8)
    return np.frombuffer(flat.tobytes(), dtype=kind), (cuts - cuts[0]) // kind.itemsize


def _kind(tokenizer: str) -> tuple[np.dtype, int]:
    from tokenizers import Tokenizer
    size = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)
    return np.dtype("<u2" if size <= 1 << 16 else "<u4"), size


def write(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Write all ``docs`` in ascending order of doc_id (null last, equal ids in any fixed order) below ``folder``.

    Returns the manifest: (shard, path, n_docs, n_ids), one row per file.
    """
    kind, size = _kind(tokenizer)
    at = new_folder(docs.sparkSession, "tokens")  # written here, as ids shrink with zstd
    encoded(docs, tokenizer).write.option("compression", "zstd").parquet(at)
    rows = docs.sparkSession.read.schema("doc_id long, ids binary, used array<long>").parquet(at)
    # at most one row per vocabulary entry comes to the driver
    ranked = [r.id for r in rows.where("used IS NOT NULL").select(F.col("used")[0].alias("id"), F.col("used")[1].alias("n")).groupBy("id").agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "id").select("id").collect()]
    ids = rows.where("ids IS NOT NULL").select("doc_id", "ids")
    order = np.array(ranked, dtype="<u4")
    with opened(f"{folder}/ranks", "w") as out:
        out.write(order.tobytes())
    rank = np.zeros(size, dtype=np.uint32)
    rank[order] = np.arange(len(order))

    def save(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        path, out, n_docs, n_ids = f"{folder}/{shard:06d}-{uuid.uuid4().hex}", None, 0, 0
        for batch in batches:
            out = out or opened(path, "w")
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                flat, cuts = _flat(part.column("ids"), kind)
                for doc, n, control, data in zip(part.column("doc_id").to_pylist(), np.diff(cuts).tolist(), *pack(rank[flat], cuts)):
                    out.write(struct.pack(HEAD, doc or 0, doc is None, n, len(data)) + control + data)
                n_docs, n_ids = n_docs + part.num_rows, n_ids + len(flat)
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "n_docs": [n_docs], "n_ids": [n_ids]})

    ordered = ids.orderBy(F.col("doc_id").asc_nulls_last(), F.crc32("ids"))
    return settle(ordered.mapInArrow(save, "shard long, path string, n_docs long, n_ids long"), "manifest")


def read(manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary, ids_crc32) of all documents of the files: start counts the ids of all before.

    Without ``with_ids`` every document is decoded all the same, but its ids stay in the task.
    """
    def load(frames):
        with opened(f"{folder}/ranks", "r") as source:
            order = np.frombuffer(source.read(), dtype="<u4")
        for frame in frames:
            for path, n_docs, before in zip(frame["path"], frame["n_docs"], frame["before"]):
                with opened(path, "r") as source:
                    waiting, size = [], 0
                    for _ in range(n_docs):
                        doc, null, n, n_data = struct.unpack(HEAD, source.read(struct.calcsize(HEAD)))
                        waiting.append((None if null else doc, n, source.read(-(-n // 4)), source.read(n_data)))
                        size += n
                        if size > 1 << 20:
                            yield _rows(waiting, order, before, with_ids)
                            before, waiting, size = before + size, [], 0
                    yield _rows(waiting, order, before, with_ids)

    # one row per file
    placed = manifest.withColumn("before", F.sum("n_ids").over(
        W.orderBy("shard").rowsBetween(W.unboundedPreceding, 0)) - F.col("n_ids"))
    files = manifest.count()
    return placed.repartition(max(1, files), "path").mapInPandas(
        load, "doc_id long, start long, n_tokens long, " + ("ids binary, " if with_ids else "") + "ids_crc32 long")


def _rows(waiting: list[tuple], order: np.ndarray, before: int, with_ids: bool) -> pd.DataFrame:
    """Documents (doc_id, number of ids, control bytes, data bytes) as rows; ``before``: ids of all documents before them."""
    counts = np.array([w[1] for w in waiting], dtype=np.int64)
    ids = order[unpack(b"".join(w[2] for w in waiting), b"".join(w[3] for w in waiting), counts)].astype("<u4")
    cuts = np.concatenate([[0], np.cumsum(counts)])
    data = memoryview(ids.tobytes())
    parts = [data[4 * a:4 * b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
    frame = pd.DataFrame({"doc_id": pd.array([w[0] for w in waiting], dtype="Int64"), "start": before + cuts[:-1], "n_tokens": counts})
    if with_ids:
        frame["ids"] = [bytes(x) for x in parts]
    return frame.assign(ids_crc32=np.array([zlib.crc32(x) for x in parts], dtype=np.int64))


def written(docs: DataFrame, tokenizer: str, with_ids: bool = True) -> DataFrame:
    """Write ``docs`` to a new shared folder and read them back: (doc_id, start, n_tokens, ids binary: little-endian
    unsigned 32-bit, only ``with_ids``, ids_crc32), one row per row of ``docs``. A null or empty text has just END."""
    folder = new_folder(docs.sparkSession, "tokenbin")
    return read(write(docs, tokenizer, folder), folder, with_ids)
