"""Encoding and decoding by a word-level BPE vocabulary, in batched numpy merge rounds.

A text is cut at white space into chunks and every distinct chunk of a batch
into words, as the tokenizer file's normalizer and pre-tokenizer say.  The
symbols of all distinct words then stand in one flat array.  A round looks the
keys of all neighbouring symbols up by binary search in the sorted keys of the
merge table, and every word merges its pair of lowest rank.  Where several
places of a word hold that pair, all are merged in the round if no pair that
the merge can form ranks lower; otherwise the first place only.  So merges
happen in the order of one queue per word (rank, then place).  Finished words
leave the array.

Scale: one pass without a shuffle.  A task holds one slice of texts
(``CHUNK_BYTES``) with its distinct words; nothing is kept between slices.

Edge cases: a null, empty or blank text has no tokens, so both digests are
those of the empty string; added tokens inside a text keep their own ids;
repeated rows give repeated results; ties of rank within a word go to the
first place; an empty table gives no rows; texts of any length are encoded
whole; only ``doc_id`` and ``text`` are read, so extra columns never clash.
A word of ``L`` symbols costs at most one round for each merge rank in it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .chunks import gather, numbered, text_slices
from .common import table

ROWS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

_NONE = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Merges:
    """The merge table of a vocabulary as sorted pair keys, for many words at a time.

    ``unsafe`` marks merges whose symbol takes part in a pair of lower rank: of those,
    a word merges only the first place in a round.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.size = max(vocab.values()) + 1
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        first = np.full(self.size, _NONE, np.int64)
        ranks = np.arange(len(merges))
        np.minimum.at(first, left, ranks)
        np.minimum.at(first, right, ranks)
        self.unsafe = first[self.merged] < ranks
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair, by binary search over the sorted keys."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all (non-empty) words one after the other, and how many each word has."""
        sizes = np.array([len(w) for w in words], np.int64)
        if not len(sizes):
            return np.empty(0, np.int64), sizes
        data = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[data]
        ends = np.cumsum(sizes) - 1
        sym[ends] = self.last[data[ends]]
        word = np.repeat(np.arange(len(words)), sizes)
        rank = np.full(len(sym), _NONE, np.int32)  # of the pair (i, i + 1)
        same = np.flatnonzero(word[:-1] == word[1:])
        rank[same] = self.ranks(sym[same], sym[same + 1])
        done_sym, done_word = [], []
        while len(sym):
            start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.append(start, len(sym)))
            lowest = np.minimum.reduceat(rank, start)
            live = np.repeat(lowest < _NONE, size)
            done_sym.append(sym[~live])
            done_word.append(word[~live])
            lowest = np.repeat(lowest, size)[live]
            sym, word, rank = sym[live], word[live], rank[live]
            if not len(sym):
                break
            hit = np.flatnonzero(rank == lowest)
            hit = hit[self._kept(hit, word[hit], rank[hit])]
            sym[hit] = self.merged[rank[hit]]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            new = np.zeros(len(sym), bool)  # pairs to look up again: the merged symbol's two
            new[hit] = True
            sym, word, rank, new = sym[stay], word[stay], rank[stay], new[stay]
            new[:-1] |= new[1:]
            again = np.flatnonzero(new)
            rank[again] = _NONE
            again = again[again < len(sym) - 1]
            again = again[word[again] == word[again + 1]]
            rank[again] = self.ranks(sym[again], sym[again + 1])
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words))

    def _kept(self, hit: np.ndarray, word: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Which hits a round merges: every second one of a touching run; of unsafe merges a word's first."""
        n = np.arange(len(hit))
        head = np.concatenate(([True], (hit[1:] != hit[:-1] + 1) | (word[1:] != word[:-1])))
        keep = (n - np.maximum.accumulate(np.where(head, n, 0))) % 2 == 0
        first = np.concatenate(([True], word[1:] != word[:-1]))
        return keep & (first | ~self.unsafe[rank])


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    #: characters that normalizing only lower-cases, one by one, and which are letters beyond ASCII
    LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
    PLAIN = re.compile(f"[!-~{LATIN}]*")
    #: white space at which texts are cut first; any other is left to the tokenizer's own table
    BLANKS = b" \t\n\r"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        if spec["decoder"] is not None or [p["type"] for p in pre] != ["Split", "ByteLevel"] or pre[1]["use_regex"]:
            raise ValueError(f"{path} is no word-level BPE as this module reads it")
        self.merges = Merges(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        # the file's own pattern, read over lower-case plain characters; a line end closes a chunk
        pattern = pre[0]["pattern"]["Regex"].replace(r"\p{L}", "a-z" + self.LATIN).replace(r"\p{N}", "0-9")
        self.plain_words = re.compile(f"{pattern}|\n")
        self.byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_re = re.compile("|".join(map(re.escape, self.added))) if self.added else None
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.added.items()}
        self.names = [names[i].encode() if i in names else b"" for i in range(max(names) + 1)]
        self.digits = [b"%d" % i for i in range(len(self.names))]

    def words(self, chunk: str) -> list[bytes | int]:
        """Words of a chunk as bytes, and its added tokens as ids."""
        out: list[bytes | int] = []
        if self.added_re is not None and (found := self.added_re.search(chunk)):
            at = 0
            while found:
                out += self.words(chunk[at:found.start()])
                out.append(self.added[found.group()])
                at = found.end()
                found = self.added_re.search(chunk, at)
            return out + self.words(chunk[at:])
        plain = self.tok.normalizer.normalize_str(chunk)
        return [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(plain)]

    def numbered_words(self, chunks: list[str]) -> tuple[list[bytes | int], list[int], np.ndarray]:
        """Distinct words, the number of each word of each chunk in order, and how many words each chunk has."""
        number: dict[str | bytes | int, int] = {}
        counts = np.zeros(len(chunks), np.int64)
        plain = [self.PLAIN.fullmatch(c) is not None for c in chunks]
        if self.added_re is not None and self.added_re.search("\n".join(chunks)):
            plain = [ok and self.added_re.search(c) is None for c, ok in zip(chunks, plain, strict=True)]
        # plain chunks in one go: lower-cased, cut and numbered together, line ends between them
        text = "\n".join([c for c, ok in zip(chunks, plain, strict=True) if ok] + [""]).lower()
        found = self.plain_words.findall(text)
        number["\n"] = 0
        codes = [number.setdefault(w, len(number)) for w in found]
        marks = np.array(codes, np.int64) == 0
        closes = np.flatnonzero(marks)
        plain = np.array(plain, bool)
        counts[plain] = np.diff(np.concatenate(([-1], closes))) - 1
        codes = np.array(codes, np.int64)[~marks]
        # all others by the tokenizer's own tables
        rest = np.flatnonzero(~plain)
        words = [self.words(chunks[i]) for i in rest]
        if len(rest):
            counts[rest] = [len(w) for w in words]
            more = np.array([number.setdefault(x, len(number)) for w in words for x in w], np.int64)
            mixed = np.empty(len(codes) + len(more), np.int64)
            mine = np.repeat(plain, counts)
            mixed[mine], mixed[~mine] = codes, more
            codes = mixed
        return [w.encode() if isinstance(w, str) else w for w in number][1:], codes - 1, counts

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks one after the other, and how many each chunk has."""
        words, codes, counts = self.numbered_words(chunks)
        ids, sizes = self._encode_words(words)
        starts = np.cumsum(sizes) - sizes
        flat = gather(ids, starts[codes], sizes[codes])
        last = np.concatenate(([0], np.cumsum(sizes[codes])))
        ends = np.concatenate(([0], np.cumsum(counts)))
        return flat, last[ends[1:]] - last[ends[:-1]]

    def _encode_words(self, words: list[bytes | int]) -> tuple[np.ndarray, np.ndarray]:
        """As ``Merges.encode``, with added tokens (given as ids) in their places."""
        kept = np.array([isinstance(w, bytes) for w in words], bool)
        ids, some = self.merges.encode([w for w in words if isinstance(w, bytes)])
        sizes = np.ones(len(words), np.int64)
        sizes[kept] = some
        out = np.empty(int(sizes.sum()), np.int64)
        mine = np.repeat(kept, sizes)
        out[mine] = ids
        out[~mine] = [w for w in words if not isinstance(w, bytes)]
        return out, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        names, codes, starts = numbered(texts, self.BLANKS)
        ids, sizes = self.encode_chunks(names)
        first = np.cumsum(sizes) - sizes
        last = np.concatenate(([0], np.cumsum(sizes[codes])))
        return gather(ids, first[codes], sizes[codes]), last[starts[1:]] - last[starts[:-1]]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space: the file names no decoder."""
        return b" ".join([self.names[i] for i in ids]).decode()

    def digests(self, texts: pa.Array) -> tuple[list[int], list[str], list[str]]:
        """Number of tokens and digests of ids and decoded text, for every text.

        Written out once for every distinct chunk, then joined text by text.
        """
        names, codes, starts = numbered(texts, self.BLANKS)
        ids, sizes = self.encode_chunks(names)
        ends = np.cumsum(sizes).tolist()
        ids = ids.tolist()
        shown, told, at = [], [], 0
        for to in ends:
            shown.append(b" ".join([self.digits[i] for i in ids[at:to]]))
            told.append(b" ".join([self.names[i] for i in ids[at:to]]))
            at = to
        some = sizes[codes] > 0  # blank chunks have no tokens
        before = np.concatenate(([0], np.cumsum(some)))[starts]
        counts = np.concatenate(([0], np.cumsum(sizes[codes])))[starts]
        codes = codes[some].tolist()
        n, ids_sha, text_sha = np.diff(counts).tolist(), [], []
        for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            mine = codes[a:b]
            ids_sha.append(hashlib.sha256(b" ".join([shown[c] for c in mine])).hexdigest())
            text_sha.append(hashlib.sha256(b" ".join([told[c] for c in mine])).hexdigest())
        return n, ids_sha, text_sha


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: the token ids of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            for doc, texts in text_slices(batch):
                ids, sizes = bpe.encode(texts)
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([doc, lists], ["doc_id", "ids"])

    return _read(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(ids: DataFrame, path: str) -> DataFrame:
    """``doc_id, text``: the decoded text of every ``ids`` (null: null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            texts = [None if x is None else bpe.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return ids.select(ids["doc_id"].cast("long").alias("doc_id"), ids["ids"]).mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded text, for every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            for doc, texts in text_slices(batch):
                n, ids_sha, text_sha = bpe.digests(texts)
                yield pa.RecordBatch.from_arrays(
                    [doc, pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _read(docs).mapInArrow(run, ROWS)


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
