"""Documents as token-id shards: each shard one wavelet-matrix file, read back by document.

Documents are range-partitioned by ``doc_id``, so the shards in order hold them in ascending order; null
ids come first, rows of one id in the order of a hash of their texts. A task closes a file once it holds
``file_ids`` ids, so memory does not grow with a partition. Files get their name only when whole, a retried
task writes the same bytes, and only files that the manifest names are read.

A null text is empty: it has the end id alone. Extra columns are ignored; an empty table gives no rows.
"""

import os
import re
import struct
import zlib
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from doorstep.llm import wavelet
from doorstep.llm.shared_files import move_into_place, store
from doorstep.llm.tables import settled
from doorstep.session import scratch_dir

END_ID = 2
FILE_IDS = 1 << 23
#: Words whose ids a Python worker keeps.
KEPT_WORDS = 600_000
#: A word of basic and Latin-1 letters in UTF-8, and the basic marks after it, which are a piece of their own.
LETTERS = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:;=-@\[-`{-~]*)")
MANIFEST = "piece int, file int, path string, n_docs long, n_ids long"


class WordIds(dict):
    """Little-endian unsigned 32-bit ids of words in UTF-8, worked out when a word is first asked for.

    Letters go to the tokenizer's model as the piece they are, basic marks after them are a piece of their own, and
    any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        mapper = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        table = ["\ufffe"] * 256
        for letter in [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]:
            for byte, char in zip(letter.encode(), mapper.pre_tokenize_str(letter)[0][0]):
                table[byte] = char
        self.table = "".join(table)
        # Words of the turn before: what is used stays.
        self.older: dict[bytes, bytes] = {}

    def turn(self) -> None:
        self.older = dict(self)
        self.clear()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if word.isalpha():
                ids = self._piece(word)
            elif found := LETTERS.fullmatch(word):
                letters, marks = found.groups()
                ids = self[letters] + self[marks] if marks else self._piece(word)
            else:
                ids = self._packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)
        self[word] = ids
        return ids

    def _piece(self, letters: bytes) -> bytes:
        lower = letters.lower() if letters.isascii() else letters.decode().lower().encode()
        piece = charmap_decode(lower, "strict", self.table)[0]
        return self._packed([token.id for token in self.model.tokenize(piece)])

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Encodes texts word by word with a cache.

    Only for tokenizers that drop white space before anything else looks at it, lower-case, keep letters
    apart from other characters and map a piece's bytes to characters: there a text's ids are its words'
    ids in a row, a word of letters is one piece, and a mark after it is the next.
    """

    def __init__(self, path: str):
        self.known = WordIds(path)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        if len(self.known) > KEPT_WORDS:
            self.known.turn()
        known = self.known.__getitem__
        return [b"".join(map(known, _lower(t or "").encode().split())) for t in texts]


def _lower(text: str) -> str:
    """A Latin-1 text in lower case, so that fewer words differ; others as they are."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Write all documents' shards under ``folder``; the manifest has a row per file, in order of (piece, file)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        piece, attempt = context.partitionId(), context.taskAttemptId()
        end = np.array([end_id], "<u4").tobytes()
        names, parts, held, number = [], [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal names, parts, held, number
            path = f"{folder}/tokens-{piece:06d}-{number:06d}.wvm"
            files, target = store(path)
            files.create_dir(os.path.dirname(target), recursive=True)
            ids = np.frombuffer(b"".join(parts), "<u4")
            with files.open_output_stream(f"{target}.{attempt}") as out:
                out.write(wavelet.dump(names, [len(p) // 4 for p in parts], ids))
            move_into_place(path, f"{path}.{attempt}")
            row = pa.RecordBatch.from_pylist(
                [{"piece": piece, "file": number, "path": path, "n_docs": len(names), "n_ids": len(ids)}],
                pa.schema([("piece", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )
            names, parts, held, number = [], [], 0, number + 1
            return row

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), 256):
                for name, coded in zip(ids[at : at + 256], encoder(tokenizer).encode(texts[at : at + 256].to_pylist())):
                    names.append(name)
                    parts.append(coded + end)
                    held += len(coded) // 4 + 1
                    if held >= file_ids:
                        yield close()
        if names:
            yield close()

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "h")
    ordered = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h").select("doc_id", "text")
    return settled(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    spark = manifest.sparkSession
    # One total per task of the writing stage goes through the driver.
    totals = manifest.groupBy("piece").agg(F.sum("n_ids").alias("n")).orderBy("piece").collect()
    before, bases = 0, []
    for row in totals:
        bases.append((row.piece, before))
        before += row.n
    base = F.broadcast(spark.createDataFrame(bases, "piece int, base long"))
    earlier = Window.partitionBy("piece").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("earlier", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    placed = placed.join(base, "piece").select("path", (F.col("base") + F.col("earlier")).alias("start"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*[c.to_pylist() for c in batch.columns]):
                files, at = store(path)
                with files.open_input_stream(at) as source:
                    doc_ids, lengths, shard = wavelet.load(source.read())
                data = shard.decode().astype("<u4").tobytes()
                ends = np.cumsum(lengths, dtype=np.int64)
                begins = ends - lengths
                crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.record_batch(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(begins + start),
                        pa.array(lengths.astype(np.int64)),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    n_files = max(1, manifest.count())
    spread = placed.repartition(min(n_files, 4 * spark.sparkContext.defaultParallelism + n_files // 8), "path")
    return spread.mapInArrow(scan, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_rows(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the documents' token files to the shared folder and read them back, a row per document."""
    return read_tokens(write_tokens(docs, tokenizer, scratch_dir(docs.sparkSession, "tokens")))
