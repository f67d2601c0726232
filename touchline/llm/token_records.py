"""Token ids as length-delimited binary records with an offset index.

A record is framed as ``length (uint64), masked CRC-32C of the length (uint32),
payload, masked CRC-32C of the payload (uint32)``, all little-endian, the framing
of TFRecord files. A payload is ``doc_id (int64), 1 if there is an id (uint8),
bytes per token id (uint8)`` and the ids, in two bytes each if the vocabulary
fits, else four. An index file beside each data file has one entry of 24 bytes
per record, ``doc_id (int64), offset (uint64), framed length (uint64)``, so that
readers can visit records in any order.

Documents are dealt over shards by ranges of doc_id and written in ascending
order. A shard is written under the name of the attempt and renamed when whole;
an attempt that is run again writes the same bytes. Memory holds a few
megabytes of text and the frames of its tokens at a time. Tasks write through
pyarrow's file systems, so the folder has to be one that these reach.

Defined cases: a NULL or empty text is the end id alone; NULL ids come first and
repeated ids keep their rows, ordered by a hash of the text; an empty table
writes no shard; other columns are not read. A checksum that does not fit
raises an error naming the file.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.arrow_text import pieces
from touchline.llm.crc32c import masked_crc32c
from touchline.llm.registry import query, table
from touchline.session import scratch_path, written

END_ID = 2
KNOWN_PIECES = 400_000
ENTRY = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u8")])
HEAD = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("width", "u1")])
FRAME_BYTES = 16
READ_BYTES = 8 << 20

# White space as Unicode defines it; letters and signs of which pre-tokenizers never
# put one of each into a token. A piece begins at white space after another character, or at a sign
# after letters; byte-level pre-tokenizers always begin a token there, so pieces can be encoded alone.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
SIGNS = r".,;:!?|#$%&*()\"'/-"
PIECE = re.compile(f"[{SPACE}]*[{LETTERS}]++(?=[{SPACE}{SIGNS}]|\\Z)|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
WORD = re.compile(f" ?[{LETTERS}]+")

MANIFEST = "shard int, data string, index string, records long, tokens long, width int"
RECORDS = "doc_id long, shard int, offset long, start long, n_tokens long, ids_crc32 long"


class KnownPieces(dict):
    """The ids of pieces met before, as bytes; a new piece is encoded, and kept while there is room."""

    def __init__(self, tokenizer, limit: int) -> None:
        super().__init__()
        self.tokenizer, self.model, self.limit = tokenizer, tokenizer.model, limit
        # How the tokenizer writes a blank and each letter in the words of its model.
        blank_and_letters = [" ", *filter(re.compile(f"[{LETTERS}]").match, map(chr, range(256)))]
        self.written = {
            ord(c): "".join(part for part, _ in tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in blank_and_letters
        }

    def __missing__(self, piece: str) -> bytes:
        if WORD.fullmatch(piece):
            # One word of the model: nothing to split.
            ids = array("I", [token.id for token in self.model.tokenize(piece.translate(self.written))]).tobytes()
        else:
            ids = array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        if len(self) < self.limit:
            self[piece] = ids
        return ids


class TextEncoder:
    """Token ids of whole texts from a tokenizer file.

    With a plain byte-level pre-tokenizer the library encodes each distinct piece
    of a text once and the pieces' ids are joined; other files encode texts whole.
    """

    def __init__(self, path: str, known_pieces: int = KNOWN_PIECES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        before = config.get("pre_tokenizer") or {}
        self.by_piece = (
            config.get("normalizer") is None
            and config["model"].get("type") == "BPE"
            and not config["model"].get("dropout")
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and all(re.fullmatch(f"[^{SPACE}{LETTERS}].*[^{SPACE}{LETTERS}]", t["content"]) for t in config["added_tokens"])
            and not any(re.search(f"[{SPACE}]", t["content"]) or t["lstrip"] or t["rstrip"] for t in config["added_tokens"])
        )
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.known = KnownPieces(self.tokenizer, known_pieces) if self.by_piece else None

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if self.known is None:
            encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [array("I", e.ids).tobytes() for e in encoded]
        return [b"".join(map(self.known.__getitem__, PIECE.findall(text))) for text in texts]


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> TextEncoder:
    """The encoder stays with the worker process, so that later tasks know the pieces of earlier ones."""
    return TextEncoder(path)


def frame(payloads: list[bytes]) -> list[bytes]:
    """Payloads with their lengths and masked checksums around them."""
    lengths = [np.uint64(len(p)).tobytes() for p in payloads]
    heads, tails = masked_crc32c(lengths), masked_crc32c(payloads)
    return [n + h.tobytes() + p + t.tobytes() for n, h, p, t in zip(lengths, heads, payloads, tails)]


def unframe(frames: list[bytes], name: str) -> list[bytes]:
    """The payloads of framed records after both checks of each."""
    lengths, payloads = [f[:8] for f in frames], [f[12:-4] for f in frames]
    for parts, sums in ((lengths, [f[8:12] for f in frames]), (payloads, [f[-4:] for f in frames])):
        if masked_crc32c(parts).tobytes() != b"".join(sums):
            raise ValueError(f"checksum of a record in {name}")
    return payloads


def _payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    head = np.array([(doc_id or 0, doc_id is not None, width)], HEAD).tobytes()
    return head + (ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes())


def write_token_records(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int | None = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write all documents to shards under ``folder``; returns the manifest, a row per shard in order.

    Every task reads the tokenizer file at ``tokenizer_path``. Shards are as many
    as the scan of ``docs`` has partitions, so they grow in number, not in size.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shards = max(1, rows.rdd.getNumPartitions())
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId()
        encoder = None
        for batch in batches:
            for part in pieces(batch, "text"):
                if encoder is None:
                    encoder = encoder_of(tokenizer_path)
                    width = 2 if max(encoder.vocabulary, (end_id or 0) + 1) <= 1 << 16 else 4
                    end = b"" if end_id is None else np.uint32(end_id).tobytes()
                    files, root = arrow_fs.FileSystem.from_uri(folder)
                    files.create_dir(root, recursive=True)
                    names = [f"{root}/{kind}-{shard:06d}" for kind in ("data", "index")]
                    attempts = [f"{name}.attempt-{context.taskAttemptId()}" for name in names]
                    data, index = [files.open_output_stream(name) for name in attempts]
                    offset = records = tokens = 0
                keys = part.column(0).to_pylist()
                ids = [x + end for x in encoder.encode(part.column(1).fill_null("").to_pylist())]
                frames = frame([_payload(key, x, width) for key, x in zip(keys, ids)])
                lengths = np.array([len(f) for f in frames], np.uint64)
                entries = np.empty(len(frames), ENTRY)
                entries["doc_id"] = [key or 0 for key in keys]
                entries["length"] = lengths
                entries["offset"] = offset + np.cumsum(lengths) - lengths
                data.write(b"".join(frames))
                index.write(entries.tobytes())
                offset += int(lengths.sum())
                records += len(frames)
                tokens += sum(map(len, ids)) // 4
        if encoder is not None:
            for stream in (data, index):
                stream.close()
            for attempt, name in zip(attempts, names):
                files.move(attempt, name)
            row = [[shard], [f"data-{shard:06d}"], [f"index-{shard:06d}"], [records], [tokens], [width]]
            types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
            columns = [pa.array(v, t) for v, t in zip(row, types)]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "data", "index", "records", "tokens", "width"])

    return written(dealt.mapInArrow(write, MANIFEST), "token-shards")


def records(files: arrow_fs.FileSystem, data: str, index: str) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Index entries and checked payloads of a shard in file order, some megabytes at a time."""
    with files.open_input_file(index) as file:
        entries = np.frombuffer(file.read(), ENTRY)
    with files.open_input_file(data) as file:
        start = 0
        while start < len(entries):
            reach = int(entries["offset"][start]) + READ_BYTES
            end = max(start + 1, int(np.searchsorted(entries["offset"] + entries["length"], reach, "right")))
            first = int(entries["offset"][start])
            block = file.read_at(int(entries["offset"][end - 1] + entries["length"][end - 1]) - first, first)
            part = entries[start:end]
            frames = [block[int(o) - first : int(o) - first + int(n)] for o, n in zip(part["offset"], part["length"])]
            yield part, unframe(frames, data)
            start = end


def shuffled_records(folder: str, data: str, index: str, seed: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of one shard in a random order, a read per record through the index."""
    files, root = arrow_fs.FileSystem.from_uri(folder)
    with files.open_input_file(f"{root}/{index}") as file:
        entries = np.frombuffer(file.read(), ENTRY)
    with files.open_input_file(f"{root}/{data}") as file:
        for i in np.random.default_rng(seed).permutation(len(entries)):
            frame_bytes = file.read_at(int(entries["length"][i]), int(entries["offset"][i]))
            yield parse(unframe([frame_bytes], data)[0])


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    """The id and the token ids of a payload."""
    head = np.frombuffer(payload, HEAD, 1)[0]
    ids = np.frombuffer(payload, f"<u{head['width']}", offset=HEAD.itemsize)
    return (int(head["doc_id"]) if head["has_id"] else None), ids.astype("<u4")


def read_token_records(folder: str, manifest: DataFrame) -> DataFrame:
    """A row per record read back from the files: where it lies and a checksum of its ids.

    ``start`` counts the ids of all records before. The totals of earlier shards
    come from the manifest, one row per shard.
    """
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("tokens").over(earlier), F.lit(0))
    shards = manifest.select("shard", "data", "index", base.alias("base"))
    tasks = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start = row["base"]
                for entries, payloads in records(files, f"{root}/{row['data']}", f"{root}/{row['index']}"):
                    parsed = [parse(p) for p in payloads]
                    counts = np.array([len(ids) for _, ids in parsed], np.int64)
                    starts = start + np.cumsum(counts) - counts
                    start += int(counts.sum())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key for key, _ in parsed], pa.int64()),
                            pa.array([row["shard"]] * len(parsed), pa.int32()),
                            pa.array(entries["offset"].astype(np.int64)),
                            pa.array(starts),
                            pa.array(counts),
                            pa.array([zlib.crc32(ids.tobytes()) for _, ids in parsed], pa.int64()),
                        ],
                        names=["doc_id", "shard", "offset", "start", "n_tokens", "ids_crc32"],
                    )

    return shards.repartition(tasks, "shard").mapInArrow(read, RECORDS)


def token_records(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write ``docs`` to a new folder beside the checkpoints and read them back."""
    folder = scratch_path(docs.sparkSession, "records")
    folder = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    return read_token_records(folder, write_token_records(docs, folder, tokenizer_path))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op5_token_records")
def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_records(table(spark, sf_dir, "documents"), default_tokenizer())
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "offset")
