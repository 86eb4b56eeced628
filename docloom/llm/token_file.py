"""Token ids in files of independent zstandard frames with a trailing seek table.

Layout of a file, all integers little-endian:

    frame ...        zstandard frames; each holds whole documents' ids as u32
    skippable frame  the document index: zstandard bytes of (doc_id i64, has_id u8,
                     n_ids u64) columns, then u64 number of documents
    skippable frame  the seek table of the public "zstandard seekable format":
                     compressed size, content size and the low 32 bits of the
                     content's XXH64 for each frame; number of frames, flags, magic

A reader fetches the seek table from the end, the index before it, and then only
the frames that hold the documents asked for; each is checked against its sum.

Documents lie in ascending ``doc_id`` order (NULL first, then by a hash of the
text) within and across files. Texts are range-partitioned by that order, so one
id that holds many rows is spread as well, and are encoded where they land. A
task writes each file under a name of its own attempt and then renames it, so a
repeated task leaves the same files. Paths go through pyarrow's file systems and
must lie in a folder that all executors share.

Edge cases: NULL and empty texts are documents of the end id alone; an empty table
gives no files; repeated ids stay separate documents.
"""

from __future__ import annotations

import gc
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.arrays import WordHasher, arrow_batches, chunk_table, distinct_spans, slices, text_bytes
from docloom.llm.bpe import CUT, ODD, WORD_END, WordCache, read_text
from docloom.session import materialize, scratch_folder

#: Ids in a frame, unless one document has more; ids in a file likewise.
FRAME_IDS = 1 << 18
FILE_IDS = 1 << 27
LEVEL = 1
#: Distinct chunks one worker remembers, twice.
CACHE_CHUNKS = 400_000

# Fixed values of the zstandard (seekable) format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE_MAGIC, HAS_SUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80

MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"


# ------------------------------------------------------------- encoding -----
class LibraryEncoder:
    """Ids of words by the tokenizers library.

    Distinct words go to it joined by spaces, one long text for all: each gives ids
    up to one that ends a word. Texts of other letters go to it whole.
    """

    def __init__(self, source: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(source)
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        for token, n in self.library.get_vocab().items():
            self.ends[n] = token.endswith(WORD_END)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def cut_other(self, text: str) -> list[str]:
        return [CUT + text]

    def encode(self, words: list[str]) -> list[bytes]:
        found: list[bytes] = []
        for at in range(0, len(words), 20_000):
            found += self._encode(words[at : at + 20_000])
        return found

    def _encode(self, words: list[str]) -> list[bytes]:
        if not any(w[0] == CUT for w in words):
            (ids,) = self.ids([" ".join(words)])
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(words) and stops[-1] == len(ids):
                data, stops = ids.tobytes(), [0, *(stops * 4).tolist()]
                return [data[a:b] for a, b in zip(stops[:-1], stops[1:], strict=True)]
        return [x.tobytes() for x in self.ids([w[1:] if w[0] == CUT else w for w in words])]


class TextEncoder:
    """Ids of whole texts. A slice's distinct chunks (between white space) are encoded, all others point to them."""

    def __init__(self, source: str) -> None:
        library = LibraryEncoder(source)
        self.words = WordCache(library.cut_other, library.encode)
        self.hasher = WordHasher(chunk_table())
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks: plain ones are cut all at once, as every sign of a chunk is in one of its words."""
        out: list[bytes] = [b""] * len(chunks)
        plain = [k for k, c in enumerate(chunks) if c.isascii()]
        if plain and not ODD.search(text := " ".join([chunks[k] for k in plain])):
            words, raw = self.words.learn(self.words.cut_ascii(text.lower()))
            ends = np.searchsorted(np.cumsum([len(w) for w in words]), np.cumsum([len(chunks[k]) for k in plain])) + 1
            parts = [raw[w] for w in words]
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in parts])[ends - 1]]).tolist()
            ids = b"".join(parts)
            for k, a, b in zip(plain, cuts[:-1], cuts[1:], strict=True):
                out[k] = ids[a:b]
        else:
            plain = []
        other = sorted(set(range(len(chunks))) - set(plain))
        for k, words in zip(other, self.words.cut([chunks[k] for k in other]), strict=True):
            out[k] = b"".join([self.words.raw[w] for w in words])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and where each text's ids start (n + 1)."""
        data, offsets = text_bytes(texts)
        mapped, starts, ends = self.hasher.spans(data, offsets)
        hashes = self.hasher.hashes(mapped, starts, ends)
        at, which = distinct_spans(data, starts, ends, hashes)
        if len(self.known) > CACHE_CHUNKS:  # common chunks outlive a full memory
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        bounds = zip(starts[at].tolist(), ends[at].tolist(), strict=True)
        raw = data.tobytes()
        chunks = [raw[a:b] for a, b in bounds]
        new = [c for c in chunks if c not in known]
        if older:
            known.update({c: older[c] for c in new if c in older})
            new = [c for c in new if c not in known]
        for low in range(0, len(new), 50_000):
            part = new[low : low + 50_000]
            known.update(zip(part, self._chunks([c.decode() for c in part]), strict=True))
        ids = [known[c] for c in chunks]
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4")
        many = sizes[which]
        after = np.cumsum(many)
        place = np.repeat((np.cumsum(sizes) - sizes)[which] - after + many, many) + np.arange(int(many.sum()))
        return flat[place], np.concatenate([[0], after])[np.searchsorted(starts, offsets)]


# --------------------------------------------------------------- writing ----
class FrameFile:
    """One file being written: documents gather into frames, frames go out as they fill."""

    def __init__(self, files: pafs.FileSystem, path: str) -> None:
        self.files, self.path, self.draft = files, path, f"{path}.{uuid.uuid4().hex}.draft"
        self.out = files.open_output_stream(self.draft)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)
        self.seek: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int | None, int]] = []
        self.held: list[bytes] = []
        self.held_ids = self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        if self.held_ids and self.held_ids + n > FRAME_IDS:
            self.flush()
        self.docs.append((doc_id, n))
        self.held.append(ids)
        self.held_ids += n
        self.n_ids += n

    def flush(self) -> None:
        content = b"".join(self.held)
        frame = self.zstd.compress(content)
        self.out.write(frame)
        self.seek.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.held, self.held_ids = [], 0

    def close(self) -> None:
        if self.held:
            self.flush()
        doc_ids = np.array([d or 0 for d, _ in self.docs], "<i8").tobytes()
        has_id = np.array([d is not None for d, _ in self.docs], "u1").tobytes()
        sizes = np.array([n for _, n in self.docs], "<u8").tobytes()
        index = self.zstd.compress(doc_ids + has_id + sizes) + struct.pack("<Q", len(self.docs))
        table = b"".join(struct.pack("<III", *s) for s in self.seek) + struct.pack("<IBI", len(self.seek), HAS_SUMS, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        self.out.write(b"")
        self.out.close()
        self.files.move(self.draft, self.path)


def write_documents(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, parts: int | None = None) -> DataFrame:
    """Encode all documents, write them to ``folder`` and return the stored list of files (MANIFEST)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({"source": read_text(tokenizer)})
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.set_threshold(200_000, 50, 50)
        files, root = pafs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        file, held = None, shared.value
        seq, done = 0, []

        def finish() -> None:
            file.close()
            done.append((part, seq, f"part-{part:06d}-{seq:06d}.zst", len(file.docs), file.n_ids))

        for batch in batches:
            for piece in slices(batch):
                # the tasks of one worker share what it was sent, and so its encoder and what that knows
                encoder = held["encoder"] = held.get("encoder") or TextEncoder(held["source"])
                ids, first = encoder.encode(piece.column("text"))
                first = first.tolist()
                for doc_id, a, b in zip(piece.column("doc_id").to_pylist(), first[:-1], first[1:], strict=True):
                    if file is not None and file.n_ids >= FILE_IDS:
                        finish()
                        file, seq = None, seq + 1
                    if file is None:
                        files.create_dir(root, recursive=True)
                        file = FrameFile(files, f"{root}/part-{part:06d}-{seq:06d}.zst")
                    file.add(doc_id, ids[a:b].tobytes() + end)
        if file is not None:
            finish()
        columns = list(zip(*done, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["part", "seq", "path", "n_docs", "n_ids"])

    arrow_batches(docs)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    sorted_docs = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return materialize(sorted_docs.mapInArrow(run, MANIFEST), "token-files")


# --------------------------------------------------------------- reading ----
class FrameReader:
    """Random access to one file."""

    def __init__(self, files: pafs.FileSystem, path: str) -> None:
        self.input = files.open_input_file(path)
        size = self.input.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != HAS_SUMS:
            raise ValueError(f"{path}: no seek table")
        table_at = size - 9 - 12 * n
        self.seek = np.frombuffer(self._at(table_at, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.frame_at = np.concatenate([[0], np.cumsum(self.seek[:, 0])])
        index_at = int(self.frame_at[-1])
        index = self._at(index_at + 8, table_at - 8 - index_at - 8)
        (docs,) = struct.unpack("<Q", index[-8:])
        raw = zstandard.ZstdDecompressor().decompress(index[:-8], max_output_size=17 * docs)
        self.doc_ids = np.frombuffer(raw[: 8 * docs], "<i8")
        self.has_id = np.frombuffer(raw[8 * docs : 9 * docs], "u1").astype(bool)
        self.sizes = np.frombuffer(raw[9 * docs :], "<u8").astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        ends = np.cumsum(self.seek[:, 1]) // 4
        self.frame_of = np.searchsorted(ends, self.starts, side="right")
        self.frame_start = ends - self.seek[:, 1] // 4
        self.path = path

    def _at(self, at: int, size: int) -> bytes:
        self.input.seek(at)
        return self.input.read(size)

    def frame(self, k: int) -> bytes:
        """Content of one frame, checked."""
        content = zstandard.ZstdDecompressor().decompress(self._at(int(self.frame_at[k]), int(self.seek[k, 0])), max_output_size=int(self.seek[k, 1]))
        if len(content) != self.seek[k, 1] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.seek[k, 2]:
            raise ValueError(f"{self.path}: frame {k} is damaged")
        return content

    def documents(self, wanted: np.ndarray) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, ids before it in this file, its ids) of the documents at these positions; one frame at a time."""
        last, content = -1, b""
        for i in wanted:
            k = int(self.frame_of[i])
            if k != last:
                last, content = k, self.frame(k)
            at = 4 * int(self.starts[i] - self.frame_start[k])
            yield int(self.doc_ids[i]) if self.has_id[i] else None, int(self.starts[i]), content[at : at + 4 * int(self.sizes[i])]


def read_documents(manifest: DataFrame, folder: str, doc_ids: list[int] | None = None, ids: bool = True) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32, ids) from the files; ``doc_ids`` reads the frames of those documents only."""
    starts = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    listed = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(starts), F.lit(0)))
    wanted = None if doc_ids is None else np.array(sorted(doc_ids), np.int64)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                files, root = pafs.FileSystem.from_uri(folder)
                reader = FrameReader(files, f"{root}/{path}")
                at = np.arange(len(reader.doc_ids)) if wanted is None else np.flatnonzero(np.isin(reader.doc_ids, wanted) & reader.has_id)
                rows, held = [], 0
                for doc_id, before, raw in reader.documents(at):
                    rows.append((doc_id, start + before, len(raw) // 4, zlib.crc32(raw), np.frombuffer(raw, "<i4") if ids else None))
                    held += len(raw) * ids + 32
                    if held > 16 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
        columns += [pa.array([r[4] for r in rows], pa.list_(pa.int32()))] * ids
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * ids])

    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return listed.select("path", "start").repartition(parts, "path").mapInArrow(run, schema)


def new_folder(docs: DataFrame) -> str:
    """A folder for one set of files, in the shared folder."""
    return f"{scratch_folder(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
