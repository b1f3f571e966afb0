"""Token ids as flat binary files with document offsets.

A data set is a folder of shards. Shard `n` holds a contiguous range of ``doc_id``:

* ``<shard>.bin`` unsigned little-endian ids, 2 bytes each where the vocabulary
  allows it, else 4, without any header;
* ``<shard>.idx`` signed 64-bit offsets into it, in ids: one for each document and
  one for the end;
* ``<shard>.doc`` the documents' ids, 64 bits each.

Tasks write their shards on their own. A manifest table names the shards that count,
with their sizes, and so commits the data set: what a lost or repeated task leaves
behind is in no manifest. The place of a shard in the whole stream is the sum of the
shards before it, a prefix sum over one manifest row per shard.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketweave.llm.common import held, map_arrow
from basketweave.workspace import Workspace

# Stands for a null doc_id in a .doc file.
NO_ID = -(1 << 63)
# Distinct pieces of text whose ids a worker remembers; it forgets them all beyond.
CACHE_PIECES = 500_000
# Letters below this one have no special cases of case or composition.
LATIN_END = "\u0180"
# Documents that are encoded together.
SLICE = 256

MANIFEST = (
    "shard long, name string, width int, docs long, tokens long, first_doc long, last_doc long"
)
MANIFEST_NAMES = [column.split()[0] for column in MANIFEST.split(", ")]


class Letters(dict):
    """Characters as the byte-level alphabet writes them.

    Bytes that print stand for themselves, the others for characters from U+0100 on.
    """

    def __init__(self):
        super().__init__()
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(shown)]
        self._of = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def bytes(self) -> dict[str, int]:
        """The byte that each letter of the alphabet stands for."""
        return {letter: byte for byte, letter in self._of.items()}

    def __missing__(self, letter: str) -> str:
        self[letter] = "".join(self._of[b] for b in letter.encode())
        return self[letter]


class Encoder:
    """Encodes texts with a file of the tokenizers library.

    With `words`, a text is cut at blanks and line ends, and each distinct piece is
    encoded once. A piece of lower-case Latin letters goes straight to the library's
    model, spelt in the byte-level alphabet; any other piece goes through the whole
    tokenizer. This suits byte-level tokenizers that lower-case, drop white space and
    part letters from the rest; others must encode whole texts.
    """

    def __init__(self, path: str, words: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = words
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self._letters, self._cache = Letters(), {}

    def pack(self, ids: list[int]) -> bytes:
        values = array(self.code, ids)
        if sys.byteorder == "big":
            values.byteswap()
        return values.tobytes()

    def _raw(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [self.pack(x.ids) for x in found]

    def _learn(self, pieces: set[str]) -> None:
        """Remember the ids of `pieces`.

        A letter and a stop after it never meet in a token, so they are encoded apart.
        """
        cache, model, spelt = self._cache, self.tokenizer.model, self._letters
        if len(cache) + len(pieces) > CACHE_PIECES:
            cache.clear()
        stops = {p: p[-1] for p in pieces if len(p) > 1 and p[-1] in ".,!?;:" and p[-2].lower().isalpha()}
        new = {p[:-1] if p in stops else p for p in pieces} | set(stops.values())
        other = []
        for piece in new.difference(cache):
            word = piece.lower()
            if word in cache and piece.isascii() and piece.isalpha():
                cache[piece] = cache[word]
            elif word.isalpha() and max(word) < LATIN_END and max(piece) < LATIN_END:
                spelling = word if word.isascii() else "".join([spelt[c] for c in word])
                cache[piece] = self.pack([x.id for x in model.tokenize(spelling)])
            else:
                other.append(piece)
        cache.update(zip(other, self._raw(other), strict=True))
        for piece, stop in stops.items():
            cache[piece] = cache[piece[:-1]] + cache[stop]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.words:
            return self._raw(texts)
        cut = [[p for p in t.replace("\n", " ").split(" ") if p] for t in texts]
        out = []
        for pieces in cut:
            new = set(pieces).difference(self._cache)
            if new:
                self._learn(new | set(pieces) if len(self._cache) + len(new) > CACHE_PIECES else new)
            out.append(b"".join([self._cache[p] for p in pieces]))
        return out


def _encoder(path: str, words: bool) -> Encoder:
    """The worker's encoder, kept for its next task."""
    return held("tokens", (path, words), lambda: Encoder(path, words))


@dataclass(frozen=True)
class TokenFiles:
    """A written data set: its folder and its manifest, one row per shard."""

    folder: str
    manifest: DataFrame
    shards: int


def write_token_files(
    docs: DataFrame,
    ws: Workspace,
    tokenizer: str,
    end_id: int,
    words: bool = False,
    folder: str | None = None,
) -> TokenFiles:
    """Encode `docs` (``doc_id``, ``text``; other columns are ignored) into a folder.

    Documents stand in ascending order of ``doc_id`` (null first); equal ids stand in
    the order of their texts. A null or empty text is the end id alone. An empty table
    gives an empty manifest. `folder` is a URI that all executors can write to; it
    defaults to a new one in `ws`.
    """
    folder = folder or f"{ws.path}/tokens"
    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
        .repartitionByRange("doc_id", F.crc32("text"))
        .sortWithinPartitions("doc_id", "text")
    )

    def run(batches):
        encoder, context = _encoder(tokenizer, words), TaskContext.get()
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        store, root = fs.FileSystem.from_uri(folder)
        ends, ids, out = [0], [], None
        end = encoder.pack([end_id])
        for batch in batches:
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/{name}.bin")
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, data in zip(part.column(0).to_pylist(), encoder.encode(texts), strict=True):
                    out.write(data + end)
                    ends.append(ends[-1] + len(data) // len(end) + 1)
                    ids.append(NO_ID if doc_id is None else doc_id)
        if out is None:
            return
        out.close()
        for kind, values in (("idx", ends), ("doc", ids)):
            with store.open_output_stream(f"{root}/{name}.{kind}") as f:
                f.write(np.array(values, "<i8").tobytes())
        row = [context.partitionId(), name, len(end), len(ids), ends[-1], ids[0], ids[-1]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([v], type=pa.string() if n == "name" else pa.int32() if n == "width" else pa.int64())
                for n, v in zip(MANIFEST_NAMES, row, strict=True)
            ],
            names=MANIFEST_NAMES,
        )

    written = ws.write("manifest", map_arrow(ordered, run, MANIFEST))
    before = F.sum("tokens").over(W.orderBy("shard")) - F.col("tokens")
    return TokenFiles(folder, written.df.withColumn("base", before), written.rows)


def _bytes(store: fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A file's numbers, memory-mapped where the file system is local."""
    if not os.path.isfile(path) or not isinstance(store, fs.LocalFileSystem):
        with store.open_input_file(path) as f:
            return np.frombuffer(f.read(), dtype)
    return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)


def read_token_files(files: TokenFiles, with_ids: bool = False) -> DataFrame:
    """One row per document of a data set, read back from its files.

    ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32``, the unsigned CRC of its ids as 32-bit integers; `with_ids` adds
    ``ids``. Each shard is one task.
    """
    folder = files.folder
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = ", ".join(f"{n} array<long>" if n == "ids" else f"{n} long" for n in names)

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for shard in batch.to_pylist():
                path = f"{root}/{shard['name']}"
                data = _bytes(store, f"{path}.bin", f"<u{shard['width']}")
                ends = _bytes(store, f"{path}.idx", "<i8")
                ids = _bytes(store, f"{path}.doc", "<i8")
                for at in range(0, len(ids), 1000):
                    docs, cuts = ids[at : at + 1000], ends[at : at + 1001]
                    each = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
                    columns = [
                        pa.array(docs, pa.int64(), mask=np.asarray(docs == NO_ID)),
                        pa.array(shard["base"] + cuts[:-1], pa.int64()),
                        pa.array(np.diff(cuts), pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in each], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array([x.tolist() for x in each], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    spread = files.manifest.select("shard", "name", "width", "base")
    return map_arrow(spread.repartition(max(1, files.shards)), run, schema)
