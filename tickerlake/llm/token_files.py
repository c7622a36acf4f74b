"""Operator 9: token ids as flat unsigned integer files with 64-bit offsets.

Documents are dealt to files by ranges of their id, so files and the rows in
them are in ascending id order. A task tokenises its texts and appends ids to
``tokens-NNNNN.bin`` (little-endian, 2 or 4 bytes by the size of the
vocabulary) and the running count before each document to
``offsets-NNNNN.bin`` (int64, one more entry than documents) with
``ids-NNNNN.bin`` (int64 document ids). It writes under a name of its own
attempt and renames at the end: a task that is run again replaces the same
file with the same bytes. ``index.json`` lists the files with their bases, the
prefix sums of the files' counts. ``TokenFiles`` maps the files into memory.

Defined cases: a null text is empty and yields the end id alone; a null id is
written as -2**63 and comes first; equal ids lie next to each other, in the
order of their texts; no rows make no files and an empty index.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm.common import partitions, process_cache, scratch, slices, written

NULL_ID = -(1 << 63)
CACHE_WORDS = 600_000     # remembered words per worker process, then it starts anew
# Letters that normalisation leaves alone and whose lower case is one letter
# whatever stands beside them (so not U+0130).
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
# Of words on lines of their own those with anything else, and empty ones.
_OTHER = re.compile(f"^(?:[{_LETTERS}]*[^{_LETTERS}\n].*|$)", re.M)
# Punctuation that is a word of its own behind letters: never part of a letter, digit or mark.
_TAIL = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# The word pattern under which words of letters are whole and a tail is one word.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# What keeps a text from being lowered as a whole before it is cut into words.
_UNSAFE = re.compile("[\u0130\u0250-\u200f\u2028-\u20ab\u20ad-\U0010ffff]|<\\|")


def _lowers(text: str) -> bool:
    """Whether ``text`` can be lowered as a whole; no character up to U+00FF hinders."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not _UNSAFE.search(text)
    return "<|" not in text


def open_fs(uri: str):
    """(filesystem, path) of a local path or a URI that pyarrow knows."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:") and not uri.startswith("file://"):
            return pafs.LocalFileSystem(), uri[5:]
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


class WordEncoder:
    """Ids of texts by way of ids of words.

    The tokenizer drops white space, so a text's ids are those of its
    blank-separated words in order; each word is encoded by the library once
    and remembered. Texts of Latin letters without marks are lowered first, as the
    tokenizer would; a word of such letters with trailing punctuation is two
    words. Words of letters alone need no normalisation and no cutting, so they go to
    the library's model by white space. Texts with any other character keep their capitals, as normalisation
    composes a capital and a mark before it lowers them; such words go to the library
    as they stand.
    """

    def __init__(self, path: str, wide: bool):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tok = Tokenizer.from_file(path)
        self.lean = self._lean(Tokenizer.from_file(path))
        self.kind = np.dtype("<u4" if wide else "<u2")
        self.words: dict[bytes, bytes] = {}
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        for word, i in vocab.items():
            self.ends[i] = word.endswith("</w>")

    def pack(self, ids) -> bytes:
        return np.asarray(ids, self.kind).tobytes()

    @staticmethod
    def _lean(tok):
        """``tok`` for lines of lower-case letters, which need no normalisation and
        are cut at white space alone; None if it is of another kind."""
        from tokenizers import normalizers, pre_tokenizers

        told = json.loads(tok.to_str())
        norm = (told["normalizer"] or {}).get("normalizers", [])
        cuts = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
        if not ([x["type"] for x in norm] == ["NFC", "Replace", "Lowercase"] and norm[1]["pattern"] == {"Regex": "\\s+"}
                and [x["type"] for x in cuts] == ["Split", "ByteLevel"] and cuts[0]["pattern"] == {"Regex": _WORDS}
                and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
                and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
                and told["model"].get("end_of_word_suffix") == "</w>"
                and all(x["content"].startswith("<|") for x in told["added_tokens"])):
            return None
        tok.normalizer = normalizers.Sequence([])
        tok.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return tok

    def learn(self, new: list[bytes]) -> None:
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        known = self.words
        cores = [w.rstrip(_TAIL) for w in new]
        lines = b"\n".join(cores).decode()
        odd = {w.encode() for w in _OTHER.findall(lines)}
        rest = [w for w, c in zip(new, cores) if c in odd]
        if rest:
            plain = [(w, c) for w, c in zip(new, cores) if c not in odd]
            new, cores = [w for w, _ in plain], [c for _, c in plain]
            lines = b"\n".join(cores).decode()
        cores = lines.lower().encode().split(b"\n") if cores else []
        tails = [w[len(c):] for w, c in zip(new, cores)]
        rest += {t for t in tails if t}
        todo = [w for w in dict.fromkeys(cores) if w not in known]
        # All cores in one text, each ended by its own word-end token.
        if todo:
            got = self.lean.encode_batch_fast([b"\n".join(todo).decode()], add_special_tokens=False)[0]
            ids = np.asarray(got.ids, self.kind)
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize
            if len(cuts) == len(todo):
                raw, cuts = ids.tobytes(), cuts.tolist()
                known.update(zip(todo, [raw[a:b] for a, b in zip([0, *cuts], cuts)]))
            else:
                rest += todo
        rest = [w for w in dict.fromkeys(rest) if w not in known]
        for word, e in zip(rest, self.tok.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)):
            known[word] = self.pack(e.ids)
        known.update([(w, known[c] + known[t] if t else known[c]) for w, c, t in zip(new, cores, tails)])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if self.lean is None:  # a tokenizer that cuts words otherwise
            return [self.pack(e.ids) for e in self.tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        split = []
        for text in texts:
            text = text or ""
            split.append((text.lower() if _lowers(text) else text).encode().split())
        missing = set().union(*split).difference(self.words)
        if missing:
            self.learn(list(missing))
        of = self.words.__getitem__
        try:
            return [b"".join(map(of, ws)) for ws in split]
        except KeyError:       # the memory was emptied on the way
            self.learn(list(set().union(*split)))
            return [b"".join(map(of, ws)) for ws in split]


def write_token_files(docs: DataFrame, out: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", files: int | None = None) -> DataFrame:
    """Write ``docs`` to ``out`` (a shared folder) and return one row per file
    (file, docs, tokens, base). ``tokenizer``: a tokenizers JSON file that
    drops white space; ``end_id`` closes each document."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    wide = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) > 1 << 16
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.col(f"`{text_col}`").alias("text"))
    n = files or partitions(spark)
    filesystem, root = open_fs(out)
    filesystem.create_dir(root, recursive=True)

    def run(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        part, own = ctx.partitionId(), f"{ctx.partitionId():05d}"
        where, base = open_fs(out)
        key = f"encoder:{tokenizer}:{wide}"
        cache = process_cache("tokenizers")
        enc = cache.get(key) or cache.setdefault(key, WordEncoder(tokenizer, wide))
        end, width = enc.pack([end_id]), enc.kind.itemsize
        kinds = ("tokens", "offsets", "ids")
        temp = {k: f"{base}/_{k}-{own}-{ctx.taskAttemptId()}" for k in kinds}
        streams, tokens, count = None, 0, 0
        for batch in batches:
            for piece in slices(batch, "text"):
                if streams is None:
                    streams = {k: where.open_output_stream(temp[k]) for k in kinds}
                packed = enc.encode(piece.column("text").to_pylist())
                lengths = np.fromiter((len(x) // width + 1 for x in packed), np.int64, len(packed))
                streams["tokens"].write(end.join(packed) + end)
                streams["offsets"].write((tokens + np.cumsum(lengths) - lengths).astype("<i8").tobytes())
                streams["ids"].write(piece.column("id").to_numpy().astype("<i8").tobytes())
                tokens, count = tokens + int(lengths.sum()), count + len(packed)
        if streams is None:
            return
        streams["offsets"].write(np.array([tokens], "<i8").tobytes())
        for k in kinds:
            streams[k].close()
            where.move(temp[k], f"{base}/{k}-{own}.bin")
        yield pa.RecordBatch.from_pydict({"file": pa.array([part], pa.int32()), "docs": [count], "tokens": [tokens]})

    dealt = rows.repartitionByRange(n, "id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    made = written(dealt.mapInArrow(run, "file int, docs long, tokens long"), "token-files")
    listed = sorted(made.collect())            # one row per file
    base, index = 0, []
    for file, count, tokens in listed:
        index.append({"file": file, "docs": count, "tokens": tokens, "base": base})
        base += tokens
    with filesystem.open_output_stream(f"{root}/index.json") as f:
        f.write(json.dumps({"width": 4 if wide else 2, "end_id": end_id, "tokens": base, "files": index}).encode())
    return spark.createDataFrame([(x["file"], x["docs"], x["tokens"], x["base"]) for x in index],
                                 "file int, docs long, tokens long, base long")


def map_file(where, path: str, kind) -> np.ndarray:
    """The file as an array: mapped into memory on a local filesystem, read
    elsewhere."""
    if isinstance(where, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
    with where.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


class TokenFiles:
    """Random access to documents by their place in id order."""

    def __init__(self, folder: str):
        self.where, self.root = open_fs(folder)
        with self.where.open_input_stream(f"{self.root}/index.json") as f:
            self.index = json.loads(f.read())
        self.kind = np.dtype(f"<u{self.index['width']}")
        self.first = np.cumsum([0] + [x["docs"] for x in self.index["files"]])

    def file(self, k: int):
        """(ids, offsets, tokens) arrays of the k-th file."""
        own = f"{self.index['files'][k]['file']:05d}.bin"
        return tuple(map_file(self.where, f"{self.root}/{name}-{own}", kind)
                     for name, kind in (("ids", "<i8"), ("offsets", "<i8"), ("tokens", self.kind)))

    def __len__(self) -> int:
        return int(self.first[-1])

    def __getitem__(self, i: int) -> np.ndarray:
        k = int(np.searchsorted(self.first, i, side="right")) - 1
        _, offsets, tokens = self.file(k)
        j = i - int(self.first[k])
        return tokens[offsets[j]:offsets[j + 1]]


def read_token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files."""
    files = TokenFiles(folder).index["files"]

    def run(batches):
        got = TokenFiles(folder)
        for batch in batches:
            for k in batch.column("k").to_pylist():
                ids, offsets, tokens = got.file(k)
                base = got.index["files"][k]["base"]
                for at in range(0, len(ids), 10_000):
                    some = range(at, min(at + 10_000, len(ids)))
                    crc = [zlib.crc32(tokens[offsets[j]:offsets[j + 1]].astype("<u4").tobytes()) for j in some]
                    own = ids[some.start:some.stop]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(own, mask=own == NULL_ID),
                        "start": pa.array(base + offsets[some.start:some.stop]),
                        "n_tokens": pa.array(np.diff(offsets[some.start:some.stop + 1])),
                        "ids_crc32": pa.array(crc, pa.int64())})

    return spark.range(0, len(files), 1, max(1, len(files))).select(F.col("id").alias("k")).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the files to a fresh shared folder and read them back."""
    folder = scratch(docs.sparkSession, "tokens")
    write_token_files(docs, folder, tokenizer, end_id)
    return read_token_digests(docs.sparkSession, folder)
