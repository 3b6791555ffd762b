"""Documents to token files and back."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linktide.llm.common import table, text_blocks
from linktide.llm.encoding import encoder
from linktide.llm.token_file import TokenFile, write_pack
from linktide.scratch import Scratch

END_ID = 2
FILE_IDS = 16_000_000

_MANIFEST = "path string, part int, number int, n_documents long, n_ids long"


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, scratch: Scratch, *, end_id: int = END_ID,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write ``docs(doc_id, text)`` as token files below ``folder``; return the manifest.

    The manifest ``(path, part, number, n_documents, n_ids, start)`` is stored and lists
    the files in the order of their documents, with the number of ids before each. The
    order is ascending doc_id, null first; rows that repeat a doc_id follow the order of
    their texts. A null text is empty: only the end id. A file holds whole documents and
    is closed at ``file_ids`` ids. ``folder`` is any place that executors reach through
    Arrow's file systems. A task that runs again writes files of other names; only those
    of the run that counts are in the manifest.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        part, number = TaskContext.get().partitionId(), 0
        system, root = fs.FileSystem.from_uri(folder)
        doc_ids, documents, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal doc_ids, documents, size, number
            name = f"{part:06d}-{number:04d}-{uuid.uuid4().hex[:12]}.tokens"
            system.create_dir(root, recursive=True)
            with system.open_output_stream(f"{root}/{name}") as out:
                write_pack(out, doc_ids, documents)
            row = [f"{folder}/{name}", part, number, len(doc_ids), size]
            number, doc_ids, documents, size = number + 1, [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, _MANIFEST_TYPES, strict=True)],
                _MANIFEST_NAMES,
            )

        end = np.array([end_id], np.uint32)
        for rows, data, offsets in text_blocks(batches, "text"):
            encoded = encode(data, offsets)
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encoded, strict=True):
                if documents and size + len(ids) + 1 > file_ids:
                    yield flush()
                doc_ids.append(doc_id)
                documents.append(np.concatenate([ids, end]))
                size += len(ids) + 1
        if documents:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id")
    files = ordered.sortWithinPartitions("doc_id", "text").mapInArrow(run, _MANIFEST)
    files, _ = scratch.save(files, "manifest")
    # One row per file meets here, not one per document.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    return scratch.save(files.withColumn("start", start), "starts")[0]


_MANIFEST_NAMES = ["path", "part", "number", "n_documents", "n_ids"]
_MANIFEST_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]


def read_token_files(manifest: DataFrame, files_per_task: int = 4) -> DataFrame:
    """``(doc_id, start, ids)`` of every document in the files of the manifest."""
    return _read(manifest, files_per_task, digest=False)


def document_digests(manifest: DataFrame, files_per_task: int = 4) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files."""
    return _read(manifest, files_per_task, digest=True)


def _read(manifest: DataFrame, files_per_task: int, digest: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(row["path"])
                with system.open_input_file(path) as file:
                    stored = TokenFile(file)
                    doc_ids, starts = stored.index()
                    yield from pieces(stored, doc_ids, starts, row["start"])

    def pieces(stored, doc_ids, starts, before):
        first = 0
        while first < len(doc_ids):  # about a million ids at once, whole documents
            last = int(np.searchsorted(starts, starts[first] + (1 << 20), "right")) - 1
            last = min(max(last, first + 1), len(doc_ids))
            ids = stored.ids(int(starts[first]), int(starts[last]))
            cuts = starts[first : last + 1] - starts[first]
            columns = [pa.array(doc_ids[first:last], pa.int64()), pa.array(before + starts[first:last])]
            if digest:
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                columns += [pa.array(np.diff(cuts)), pa.array(sums, pa.int64())]
            else:
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int64)))
                columns.append(lists)
            yield pa.RecordBatch.from_arrays(columns, names)
            first = last

    names = ["doc_id", "start", "n_tokens", "ids_crc32"] if digest else ["doc_id", "start", "ids"]
    schema = "doc_id long, start long, " + ("n_tokens long, ids_crc32 long" if digest else "ids array<long>")
    spark = manifest.sparkSession
    tasks = max(1, -(-manifest.count() // files_per_task), int(spark.sparkContext.defaultParallelism))
    return manifest.select("path", "start").repartition(tasks).mapInArrow(run, schema)


def token_output(docs: DataFrame, scratch: Scratch, tokenizer: str | None = None) -> DataFrame:
    """Write the documents' token files to the session's shared folder and read them back."""
    folder = scratch.path("tokens")
    manifest = write_token_files(docs, folder, tokenizer or word_bpe_path(), scratch)
    return document_digests(manifest)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"), Scratch(spark))
