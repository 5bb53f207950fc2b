"""Alignment of two tokenizers' tokens, as a monoid of fragments.

Tokenizer A (byte-level BPE) and tokenizer B (pieces with byte fallback) both
spell a text's bytes.  Offsets where tokens of both end cut them into groups.
A *fragment* covers a range of bytes and owns the tokens that end in it: an open
prefix (the tokens up to its first common end), closed groups, and an open
suffix (the tokens after its last).  ``compose`` joins neighbouring fragments:
the left suffix and the right prefix become one group.  It is associative, so
fragments of a very long document are made by many tasks and composed by a tree
of groupings, ``FAN`` neighbours at a time.

A long text is cut into pieces at a single space between two other characters,
where both tokenizers always begin a token; tokens are made piece by piece, and
fragments end at fixed multiples of ``RANGE_BYTES``, wherever tokens stand.  A
shorter text is one fragment from its start to its end and takes no shuffle.

Links that end together join ids of which one's bytes end the other's, so all
pairs that any corpus can hold follow from the two vocabularies (324,302 for the
public files).  Corpus-wide counts are therefore bounded by the vocabularies,
and are broadcast as one array.

Edge cases: a null or empty text, or one whose A or B tokens do not spell a space
and the text, has no tokens: zeros and an empty string.  Repeated rows and ids
are aligned row by row, and count in the links as often as they occur; ties for
the highest count all count as best; an empty table gives no rows; only
``doc_id`` and ``text`` are read.  A text without any single space cannot be cut
into pieces, so one task makes its tokens, but its fragments are ranges like any
other's.  The composed groups of a document stand in one row, as its text does.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import gather, numbered, text_slices
from .common import save, table
from .word_bpe import byte_symbols

#: longer texts (in characters) are aligned by several tasks
LONG_CHARS = 65_536
#: characters of a piece at least; it ends at the next place where it may
PIECE_CHARS = 32_768
#: a fragment of a long text ends at the next multiple of these bytes
RANGE_BYTES = 16_384
#: neighbouring fragments composed by one call
FAN = 8
#: bytes of text aligned at a time (or one longer text)
SLICE_BYTES = 2_000_000
#: chunks encoded as one text
TOGETHER = 1_000

DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<int>"
FRAGMENT = ("ok boolean, ended boolean, head_a array<int>, head_b array<int>, n_a long, n_b long, n_groups long, "
            "closed binary, links array<int>, tail_a array<int>, tail_b array<int>")
FIELDS = [f.split()[0] for f in FRAGMENT.split(", ")]

_BLANK = "[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
#: a space that is not between two other characters
_TOUCHING = f"^ | $| {_BLANK}|{_BLANK} "
_CUT = re.compile(r"(?<=\S) (?=\S)")
_PLAIN = re.compile("[\n -~¡-¬®-ɏ]*")


class Vocabulary:
    """Bytes and decimal digits of every id of a tokenizer, as flat arrays."""

    def __init__(self, spelled: list[bytes]):
        self.spelled = spelled
        self.size = np.array([len(b) for b in spelled], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        shown = [b"%d," % i for i in range(len(spelled))]
        self.shown_size = np.array([len(b) for b in shown], np.int64)
        self.shown_start = np.cumsum(self.shown_size) - self.shown_size
        self.shown = np.frombuffer(b"".join(shown), np.uint8)


class Pair:
    """Both tokenizers of an alignment."""

    def __init__(self, path_a: str, path_b: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path_a)
        self.tok.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.fast = self._ranked(ranks) if ranks else None
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        spelled_a = [b""] * self.tok.get_vocab_size()
        for token, i in self.tok.get_vocab().items():
            spelled_a[i] = token.encode() if token in special else bytes(byte_of[c] for c in token)
        self.a = Vocabulary(spelled_a)
        self.b = Vocabulary([self._piece(i) for i in range(self.pieces.get_piece_size())])
        self.codes = self._pairs()

    @staticmethod
    def _ranked(path: str):
        import base64

        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={})

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def _pairs(self) -> np.ndarray:
        """Keys of all id pairs of which one's bytes end the other's, sorted."""
        def by_bytes(v: Vocabulary) -> dict[bytes, list[int]]:
            out: dict[bytes, list[int]] = {}
            for i, b in enumerate(v.spelled):
                out.setdefault(b, []).append(i)
            return out

        of_a, of_b, n = by_bytes(self.a), by_bytes(self.b), len(self.b.size)
        keys = {i * n + j for i, b in enumerate(self.a.spelled) for k in range(len(b)) for j in of_b.get(b[k:], ())}
        keys |= {i * n + j for j, b in enumerate(self.b.spelled) for k in range(len(b)) for i in of_a.get(b[k:], ())}
        return np.array(sorted(keys), np.int64)

    def code(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of each id pair among all that can end together."""
        return np.searchsorted(self.codes, a * len(self.b.size) + b).astype(np.int32)

    def _each(self, chunks: list[str], of_b: bool) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and sizes of texts (A's: after a space each), encoded one by one."""
        found = (self.pieces.encode(chunks, num_threads=1) if of_b else
                 [e.ids for e in self.tok.encode_batch([" " + c for c in chunks], add_special_tokens=False)]) if chunks else []
        sizes = np.array([len(x) for x in found], np.int64)
        return np.fromiter((i for x in found for i in x), np.int32, int(sizes.sum())), sizes

    def _joined(self, chunks: list[str], ends: np.ndarray, of_b: bool) -> tuple[np.ndarray, np.ndarray]:
        """The same of chunks without spaces, encoded as one text and parted where their bytes end.

        Both tokenizers begin a token at a space between two other characters, so
        this gives the tokens of each.  ``ends``: the byte where each ends, a space before it.
        """
        text = " ".join(chunks)
        if not of_b and (self.fast is None or not _PLAIN.fullmatch(text)):
            return self._each(chunks, of_b)
        v = self.b if of_b else self.a
        flat = np.array(self.pieces.encode(text) if of_b else self.fast.encode_ordinary(" " + text), np.int32)
        places = np.cumsum(v.size[flat])
        at = np.searchsorted(places, ends)
        if not len(flat) or places[-1] != ends[-1] or not (places[at] == ends).all():  # a chunk is not spelled by its tokens
            return self._each(chunks, of_b)
        return flat, np.diff(at, prepend=-1)

    def _chunks(self, chunks: list[str], of_b: bool) -> tuple[np.ndarray, np.ndarray]:
        parts = [(np.empty(0, np.int32), np.empty(0, np.int64))]
        sizes = pc.binary_length(pa.array(chunks, pa.large_string())).to_numpy().astype(np.int64) + 1
        for at in range(0, len(chunks), TOGETHER):
            parts.append(self._joined(chunks[at:at + TOGETHER], np.cumsum(sizes[at:at + TOGETHER]), of_b))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A's ids of all texts (each after a space), how many each text has, and the same for B.

        Where every space of a text stands between two other characters, both
        tokenizers treat it as the sum of its space-led chunks, so each distinct
        chunk is encoded once; any other text is encoded whole.
        """
        whole = pc.match_substring_regex(texts, _TOUCHING).to_numpy(zero_copy_only=False).astype(bool)
        names, codes, starts = numbered(texts.filter(pa.array(~whole)))
        counts = np.ones(len(texts), np.int64)
        counts[~whole] = np.diff(starts)
        all_codes = np.empty(int(counts.sum()), np.int64)
        mine = np.repeat(~whole, counts)
        all_codes[mine] = codes
        all_codes[~mine] = len(names) + np.arange(int(whole.sum()))
        odd = texts.filter(pa.array(whole)).to_pylist()
        ends = np.concatenate(([0], np.cumsum(counts)))
        out = []
        for of_b in (False, True):
            parts = [self._chunks(names, of_b), self._each(odd, of_b)]
            flat = np.concatenate([p[0] for p in parts])
            sizes = np.concatenate([p[1] for p in parts])
            n = sizes[all_codes]
            last = np.concatenate(([0], np.cumsum(n)))
            out += [gather(flat, (np.cumsum(sizes) - sizes)[all_codes], n).astype(np.int64),
                    last[ends[1:]] - last[ends[:-1]]]
        return tuple(out)


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str, ranks: str | None) -> Pair:
    return Pair(path_a, path_b, ranks)


def _spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a space and each text, one after the other, and where each ends (an empty text: nothing)."""
    empty, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    texts = pc.if_else(pc.equal(texts, empty), empty, pc.binary_join_element_wise(empty, texts, space))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


class Aligned:
    """Tokens of a run of texts with their ends, and their fragments.

    ``at``: where each text's bytes begin; texts whose tokens do not spell their
    bytes are not ``ok`` and have no tokens here.
    """

    def __init__(self, both: Pair, texts: pa.Array):
        self.both = both
        data, self.at = _spaced(texts)
        empty = np.diff(self.at) == 0
        a, n_a, b, n_b = both.encode(texts)
        self.ok = self._spells(both.a, a, n_a, data) & self._spells(both.b, b, n_b, data) & ~empty
        self.a, self.end_a, of_a = self._kept(both.a, a, n_a)
        self.b, self.end_b, of_b = self._kept(both.b, b, n_b)
        mark = np.zeros(len(data) + 1, bool)
        mark[self.end_a] = True
        self.common_b = mark[self.end_b]
        mark[:] = False
        mark[self.end_b] = True
        self.common_a = mark[self.end_a]

    def _spells(self, v: Vocabulary, ids: np.ndarray, n: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Which texts' bytes are those of their tokens."""
        sizes = np.concatenate(([0], np.cumsum(v.size[ids])))
        ends = np.concatenate(([0], np.cumsum(n)))
        length = sizes[ends[1:]] - sizes[ends[:-1]]
        same = length == np.diff(self.at)
        if not same.all():  # compare only texts of the right length
            ids = ids[np.repeat(same, n)]
            data = data[np.repeat(same, np.diff(self.at))]
        wrong = np.concatenate(([0], np.cumsum(gather(v.bytes, v.start[ids], v.size[ids]) != data)))
        edge = np.concatenate(([0], np.cumsum(length[same])))
        out = same.copy()
        out[same] = wrong[edge[1:]] == wrong[edge[:-1]]
        return out

    def _kept(self, v: Vocabulary, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the texts that are ``ok``, the byte where each ends, and its text."""
        text = np.repeat(np.arange(len(n)), n)
        keep = self.ok[text]
        ids, text = ids[keep], text[keep]
        sizes = v.size[ids]
        ends = np.cumsum(sizes)
        first = np.concatenate(([True], text[1:] != text[:-1])) if len(text) else np.empty(0, bool)
        shift = self.at[text[first]] - (ends - sizes)[first]
        return ids, ends + np.repeat(shift, np.diff(np.append(np.flatnonzero(first), len(text)))), text

    def fragments(self, bounds: np.ndarray, opens: np.ndarray) -> dict[str, list]:
        """Columns of one fragment for every range ``(bounds[i], bounds[i + 1]]`` of bytes.

        ``opens``: ranges that begin where a document begins, which is a common end itself.
        """
        both = self.both
        ca, cb = np.flatnonzero(self.common_a), np.flatnonzero(self.common_b)
        links = both.code(self.a[ca], self.b[cb])
        # tokens written group by group, A's before B's: the place of each
        group_a = np.cumsum(self.common_a) - self.common_a
        group_b = np.cumsum(self.common_b) - self.common_b
        ends_a, ends_b = np.append(ca + 1, len(self.a)), np.append(cb + 1, len(self.b))
        place_a = np.arange(len(self.a)) + np.concatenate(([0], ends_b))[group_a]
        place_b = np.arange(len(self.b)) + ends_a[group_b]
        n = len(self.a) + len(self.b)
        start, size, stop = np.empty(n, np.int64), np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        start[place_a], size[place_a] = both.a.shown_start[self.a], both.a.shown_size[self.a]
        start[place_b], size[place_b] = both.b.shown_start[self.b] + len(both.a.shown), both.b.shown_size[self.b]
        stop[place_a[ca]], stop[place_b[cb]] = ord("|"), ord(";")
        text = gather(np.concatenate((both.a.shown, both.b.shown)), start, size)
        to = np.cumsum(size)
        text[to - 1] = stop
        after = to[place_b[cb]]  # of each common end: where its group's text ends
        raw = text.tobytes()

        lo_a, lo_b = np.searchsorted(self.end_a, bounds, "right"), np.searchsorted(self.end_b, bounds, "right")
        lo_c = np.searchsorted(self.end_a[ca], bounds, "right")
        ids_a, ids_b, links_ = self.a.astype(np.int32), self.b.astype(np.int32), links
        before = to - size  # where each token's text begins
        out: dict[str, list] = {f: [] for f in FIELDS}
        for i, opened in enumerate(opens.tolist()):
            a0, a1, b0, b1, c0, c1 = (int(x) for x in (*lo_a[i:i + 2], *lo_b[i:i + 2], *lo_c[i:i + 2]))
            if c0 == c1 and not opened:
                head, tail, closed, n_groups = (a1, b1), (a1, b1), b"", 0
            else:
                head = (a0, b0) if opened else (int(ca[c0]) + 1, int(cb[c0]) + 1)
                tail = (int(ca[c1 - 1]) + 1, int(cb[c1 - 1]) + 1) if c1 > c0 else (a0, b0)
                n_groups = c1 - c0 - (not opened)
                begins = 0 if not n_groups else int(before[place_a[a0]]) if opened else int(after[c0])
                closed = raw[begins:int(after[c1 - 1])] if n_groups else b""
            for name, value in (("ok", True), ("ended", opened or c1 > c0), ("head_a", ids_a[a0:head[0]]),
                                ("head_b", ids_b[b0:head[1]]), ("n_a", a1 - a0), ("n_b", b1 - b0),
                                ("n_groups", n_groups), ("closed", closed), ("links", links_[c0:c1]),
                                ("tail_a", ids_a[tail[0]:a1]), ("tail_b", ids_b[tail[1]:b1])):
                out[name].append(value)
        return out


def _group(a: np.ndarray, b: np.ndarray) -> bytes:
    return (",".join(map(str, a)) + "|" + ",".join(map(str, b)) + ";").encode()


def compose(left: dict, right: dict) -> dict:
    """One fragment of two neighbours.  Associative; a fragment without tokens changes nothing."""
    def both(x: str, y: str) -> np.ndarray:
        return np.concatenate((left[x], right[y])).astype(np.int32)

    out = {"ok": left["ok"] and right["ok"], "ended": left["ended"] or right["ended"],
           "n_a": left["n_a"] + right["n_a"], "n_b": left["n_b"] + right["n_b"], "links": both("links", "links")}
    if not left["ended"]:
        return out | {k: both(k, k) for k in ("head_a", "head_b")} | {
            k: right[k] for k in ("n_groups", "closed", "tail_a", "tail_b")}
    out |= {k: left[k] for k in ("head_a", "head_b")}
    if not right["ended"]:
        return out | {"n_groups": left["n_groups"], "closed": left["closed"],
                      "tail_a": both("tail_a", "head_a"), "tail_b": both("tail_b", "head_b")}
    return out | {"n_groups": left["n_groups"] + 1 + right["n_groups"],
                  "closed": left["closed"] + _group(both("tail_a", "head_a"), both("tail_b", "head_b")) + right["closed"],
                  "tail_a": right["tail_a"], "tail_b": right["tail_b"]}


def compose_all(parts: list[dict]) -> dict:
    """Neighbours composed in pairs, so that closed groups are copied a few times only."""
    while len(parts) > 1:
        parts = [compose(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _documents(doc: list, parts: dict[str, list], with_groups: bool) -> pa.RecordBatch:
    """Rows of whole documents from the fragments that cover them."""
    rows: dict[str, list] = {"doc_id": doc, "n_a": [], "n_b": [], "n_groups": [], "groups_sha256": [], "links": []}
    groups = []
    for ok, n_a, n_b, n, closed, links in zip(*(parts[k] for k in ("ok", "n_a", "n_b", "n_groups", "closed", "links")),
                                              strict=True):
        ok = ok and n > 0
        told = closed[:-1] if ok else b""
        groups.append(told.decode())
        for name, value in (("n_a", n_a if ok else 0), ("n_b", n_b if ok else 0), ("n_groups", n if ok else 0),
                            ("groups_sha256", hashlib.sha256(told).hexdigest() if ok else ""),
                            ("links", links if ok else [])):
            rows[name].append(value)
    arrays = [pa.array(rows["doc_id"], pa.int64()), *(pa.array(rows[k], pa.int64()) for k in ("n_a", "n_b", "n_groups")),
              pa.array(rows["groups_sha256"], pa.string()), pa.array(rows["links"], pa.list_(pa.int32()))]
    if with_groups:
        return pa.RecordBatch.from_arrays([*arrays, pa.array(groups, pa.string())], [*rows, "groups"])
    return pa.RecordBatch.from_arrays(arrays, list(rows))


def align(docs: DataFrame, path_a: str, path_b: str, ranks: str | None = None, with_groups: bool = False,
          long_chars: int = LONG_CHARS, piece_chars: int = PIECE_CHARS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A row per document: its numbers of tokens and groups, the groups' digest and the codes of its links.

    ``with_groups`` adds the groups themselves (``a1,a2|b1;a3|b2,b3``).  Codes number
    ``Pair.codes``, the id pairs that can end together.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    schema = DOCUMENT + (", groups string" if with_groups else "")

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(path_a, path_b, ranks)
        for batch in batches:
            for doc, texts in text_slices(batch, SLICE_BYTES):
                got = Aligned(both, texts)
                yield _documents(doc.to_pylist(), got.fragments(got.at, np.ones(len(texts), bool)), with_groups)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = {k: batch.column(k).to_pylist() for k in ("doc_id", *FIELDS)}
            yield _documents(parts["doc_id"], parts, with_groups)

    size = F.coalesce(F.char_length("text"), F.lit(0))
    cut = _pieces(rows.where(size > long_chars), piece_chars)
    # each stage runs one Python function a task, so that an executor keeps no more workers than it has cores
    composed = save(_tree(_fragments(cut, path_a, path_b, ranks, range_bytes)))
    return rows.where(size <= long_chars).mapInArrow(short, schema).unionByName(composed.mapInArrow(whole, schema))


def _cut(text: str, size: int) -> Iterator[str]:
    """Pieces of a text of at least ``size`` characters, without the single spaces between them."""
    at = 0
    while found := _CUT.search(text, at + size):
        yield text[at:found.start()]
        at = found.end()
    yield text[at:]


def _pieces(docs: DataFrame, size: int) -> DataFrame:
    """``row, doc_id, piece, start, text``: the pieces of every text and the byte where each begins."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                start = 0
                for k, piece in enumerate(_cut(text, size)):
                    yield pa.RecordBatch.from_pylist([{"row": row, "doc_id": doc, "piece": k, "start": start, "text": piece}],
                                                     schema=pa.schema([("row", pa.int64()), ("doc_id", pa.int64()),
                                                                       ("piece", pa.int32()), ("start", pa.int64()),
                                                                       ("text", pa.string())]))
                    start += 1 + len(piece.encode())

    # written down, so that row numbers stay the same whatever executors are lost
    return save(docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        cut, "row long, doc_id long, piece int, start long, text string"))


def _fragments(pieces: DataFrame, path_a: str, path_b: str, ranks: str | None, range_bytes: int) -> DataFrame:
    """``row, doc_id, at, piece`` and a fragment, for every byte range of every piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(path_a, path_b, ranks)
        for batch in batches:
            for r in batch.to_pylist():
                yield _piece_fragments(both, r, range_bytes)

    return pieces.repartition("row", "piece").mapInArrow(run, f"row long, doc_id long, at long, piece int, {FRAGMENT}")


def _piece_fragments(both: Pair, r: dict, size: int) -> pa.RecordBatch:
    got = Aligned(both, pa.array([r["text"]], pa.large_string()))
    if got.ok[0]:
        first, last = r["start"], r["start"] + int(got.at[-1])
        inner = np.arange(first // size + 1, -(-last // size)) * size
        bounds = np.concatenate(([first], inner, [last]))
        opens = np.zeros(len(bounds) - 1, bool)
        opens[0] = first == 0
        parts = got.fragments(bounds - first, opens)
        at = (bounds[1:] - 1) // size
    else:  # one piece that is not spelled spoils its document
        parts = {k: [b""] if k == "closed" else [0] if k.startswith("n_") else [[]] for k in FIELDS}
        parts |= {"ok": [False], "ended": [r["start"] == 0]}
        at = np.array([r["start"] // size])
    n = len(at)
    kinds = {"ok": pa.bool_(), "ended": pa.bool_(), "closed": pa.binary()}
    arrays = [pa.array([r["row"]] * n, pa.int64()), pa.array([r["doc_id"]] * n, pa.int64()), pa.array(at, pa.int64()),
              pa.array([r["piece"]] * n, pa.int32())]
    arrays += [pa.array(parts[k], kinds.get(k, pa.int64() if k.startswith("n_") else pa.list_(pa.int32()))) for k in FIELDS]
    return pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "at", "piece", *FIELDS])


def _tree(parts: DataFrame) -> DataFrame:
    """One fragment a document: ``FAN`` neighbours become one, level by level."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at", "piece"])
        whole = compose_all(pdf[FIELDS].to_dict("records"))
        first = pdf.iloc[0]
        return pd.DataFrame([{"row": first["row"], "doc_id": first["doc_id"], "at": first["at"] // FAN,
                              "piece": first["piece"], **whole}])

    parts = save(parts)
    last = parts.agg(F.max("at")).first()[0]
    if last is None:
        return parts
    while True:  # ranges numbered so far shrink by FAN a level
        parts = parts.groupBy("row", (F.col("at").cast("long") / FAN).cast("long").alias("up")).applyInPandas(
            one, parts.schema)
        last //= FAN
        if not last:
            return parts
        parts = save(parts)


def link_counts(aligned: DataFrame, n_codes: int) -> DataFrame:
    """``code, n``: how many links hold each id pair.  A task sends at most one row for each pair there can be."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_codes, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("links").flatten().to_numpy(), minlength=n_codes)
        codes = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int32)), pa.array(total[codes])], ["code", "n"])

    return aligned.select("links").mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


def weigh(aligned: DataFrame, both: Pair) -> DataFrame:
    """Adds ``n_links``, ``n_best`` and ``count_sum`` from the counts of all documents."""
    spark = aligned.sparkSession
    counts = np.zeros(len(both.codes), np.int64)
    for r in link_counts(aligned, len(both.codes)).toLocalIterator():  # at most one row per code
        counts[r["code"]] = r["n"]
    of_b = both.codes % len(both.b.size)
    highest = np.zeros(len(both.b.size), np.int64)
    np.maximum.at(highest, of_b, counts)
    shared = spark.sparkContext.broadcast((counts, (counts == highest[of_b]).astype(np.int64)))
    names = [c for c in aligned.columns if c != "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, best = shared.value
        for batch in batches:
            links = batch.column("links")
            codes = links.flatten().to_numpy()
            ends = links.offsets.to_numpy().astype(np.int64)
            ends = ends - ends[0]
            sums = [np.diff(np.concatenate(([0], np.cumsum(v[codes])))[ends]) for v in (n, best)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(np.diff(ends)), pa.array(sums[1]), pa.array(sums[0])],
                [*names, "n_links", "n_best", "count_sum"])

    schema = aligned.select(*names).schema
    for c in ("n_links", "n_best", "count_sum"):
        schema = schema.add(c, "long")
    return aligned.select(*names, "links").mapInArrow(run, schema)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    paths = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken")]
    aligned = save(align(table(spark, sf_dir, "documents"), *paths))
    return weigh(aligned, pair(*paths)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
