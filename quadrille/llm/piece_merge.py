"""Encoding and decoding with merge-type piece vocabularies.

Adjacent symbols are merged in order of score from an agenda (a heap of candidate pairs;
stale entries are skipped when they come up).  No piece holds a blank mark after another
character, nor a line feed, and none of the usual ones joins letters with signs, so a text
falls into chunks that merge on their own; each worker process remembers the chunks it has seen, up to a bound.  New chunks of an Arrow
batch are checked against the sentencepiece library, encoding and decoding, before use.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.frames import slices

BLANK = "▁"
REMEMBERED = 600_000
_CODECS: dict[str, PieceCodec] = {}


def _one_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("quadrille_one_byte", _one_byte)


class PieceCodec:
    """Vocabulary of a model file and the chunks seen so far."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        known = [self.library.id_to_piece(i) for i in range(n)]
        plain = [
            i for i in range(n)
            if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))
        ]
        self.byte_ids = {int(known[i][3:5], 16): i for i in range(n) if self.library.is_byte(i)}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        if len(self.byte_ids) != 256 or any("\n" in known[i] or BLANK in known[i].lstrip(BLANK) for i in plain):
            raise ValueError("needs a vocabulary with byte pieces whose pieces neither hold a line feed nor an inner blank")
        if any(self.library.is_unused(i) for i in plain):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.ids = {known[i]: i for i in plain}
        self.text_of = {i: known[i] for i in plain}
        # order of merging: best score first
        ordered = sorted(plain, key=lambda i: (-self.library.get_score(i), i))
        self.rank = {known[i]: r for r, i in enumerate(ordered)}
        self.by_rank = [known[i] for i in ordered]
        self.end = self.library.eos_id()
        self.chunks = self._chunks()
        self.seen: dict[str, str] = {}  # chunk: its ids, joined
        self.odd: dict[str, str] = {}  # chunks that decode to another text

    def _chunks(self) -> re.Pattern:
        """Chunks end where no piece goes on: at line feeds, before blanks, and between letters and other signs.

        A letter that some piece joins with a sign counts as a sign.
        """
        letter, joined = re.compile(r"[^\W\d_]"), set()
        for piece in self.ids:
            for a, b in zip(piece, piece[1:]):  # noqa: B905
                if BLANK not in (a, b) and bool(letter.match(a)) != bool(letter.match(b)):
                    joined.add(a if letter.match(a) else b)
        if len(joined) > 200:
            return re.compile(f"\n|{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+")
        out = re.escape("".join(sorted(joined)))
        sign = rf"[\W\d_{out}]"
        return re.compile(rf"\n|{BLANK}*[^\W\d_{out}]+|{BLANK}*(?:(?![{BLANK}\n]){sign})+|{BLANK}+")

    def merge(self, chunk: str) -> list[int]:
        """Ids of one chunk."""
        symbols = [chunk] if len(chunk) == 1 else self._by_list(chunk) if len(chunk) < 24 else self._by_heap(chunk)
        out = []
        for s in symbols:
            one = self.ids.get(s)
            if one is None:
                out.extend(self.byte_ids[b] for b in s.encode())
            else:
                out.append(one)
        return out

    def _by_list(self, chunk: str) -> list[str]:
        """For short chunks the agenda is a list, the rank of the pair at each position."""
        get, none, symbol = self.rank.get, len(self.rank), list(chunk)
        agenda = [get(a + b, none) for a, b in zip(chunk, chunk[1:])]  # noqa: B905
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)
            merged = symbol[i] = symbol[i] + symbol.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = get(symbol[i - 1] + merged, none)
            if i < len(agenda):
                agenda[i] = get(merged + symbol[i + 1], none)
        return symbol

    def _by_heap(self, chunk: str) -> list[str]:
        """The agenda holds ``rank * n + position`` of each pair that is a piece."""
        rank, symbol, n = self.rank, list(chunk), len(chunk)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            r = rank.get(symbol[i] + symbol[i + 1])
            if r is not None:
                agenda.append(r * n + i)
        heapq.heapify(agenda)
        while agenda:
            r, i = divmod(heapq.heappop(agenda), n)
            j = after[i]
            if not symbol[i] or j >= n or symbol[i] + symbol[j] != self.by_rank[r]:
                continue
            merged = symbol[i] = self.by_rank[r]
            symbol[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get(merged + symbol[k])
                if r is not None:
                    heapq.heappush(agenda, r * n + i)
            h = before[i]
            if h >= 0:
                r = rank.get(symbol[h] + merged)
                if r is not None:
                    heapq.heappush(agenda, r * n + h)
        return [s for s in symbol if s]

    def spell(self, ids: list[int]) -> str:
        """Text of ids, blank marks kept; bytes that are no text become U+FFFD, one for each."""
        out, held = [], bytearray()
        for i in ids:
            if i in self.bytes_of:
                held.append(self.bytes_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "quadrille_one_byte"))
                held.clear()
            if i in self.text_of:
                out.append(self.text_of[i])
            elif self.library.is_unknown(i):
                out.append(" ⁇ ")
        if held:
            out.append(held.decode("utf-8", "quadrille_one_byte"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """As the library's ``decode``: control ids vanish, blank marks become blanks, the first one goes."""
        first = next((i for i in ids if not self.library.is_control(i)), None)
        text = self.spell(ids)
        if first in self.text_of and text.startswith(BLANK):
            text = text[1:]
        return text.replace(BLANK, " ")

    def split(self, text: str) -> list[str]:
        return self.chunks.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def learn(self, chunks: set[str]) -> dict[str, str]:
        """The ids, joined by blanks, of at least ``chunks``."""
        if len(self.seen) > REMEMBERED:
            self.seen, self.odd = {}, {}
        known = self.seen
        new = [c for c in chunks if c not in known]
        if new:
            encoded = [self.merge(c) for c in new]
            # a line feed in front keeps the library from adding its blank to the chunk itself
            for c, own, other in zip(new, encoded, self.library.encode(["\n" + c for c in new], num_threads=1), strict=True):
                if own != other[2:]:
                    raise AssertionError(f"{c!r}: {own}, but the library has {other[2:]}")
                known[c] = " ".join(map(str, own))
            for c, own, other in zip(new, encoded, self.library.decode([[*self.line, *x] for x in encoded], num_threads=1), strict=True):
                text = self.spell(own).replace(BLANK, " ")
                if other != "\n" + text:
                    raise AssertionError(f"{c!r}: decoded to {text!r}, but the library has {other!r}")
                if text != c.replace(BLANK, " "):
                    self.odd[c] = text
        return known

    @property
    def line(self) -> list[int]:
        return [self.ids[BLANK], self.byte_ids[10]]

    def encode_joined(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """For every text its ids with the end id, joined by blanks, and the text they decode to."""
        parts = [self.split(t) for t in texts]
        ids, end = self.learn(set().union(*parts)), str(self.end)
        for text, p in zip(texts, parts, strict=True):
            joined = " ".join([*map(ids.__getitem__, p), end])
            if self.odd:
                yield joined, "".join([self.odd.get(c) or c.replace(BLANK, " ") for c in p])[1:]
            else:
                yield joined, text.replace(BLANK, " ")


def codec(path: str) -> PieceCodec:
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids``: ids of every whole text with the end id.  A null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = own.encode_joined([t or "" for t in batch.column("text").to_pylist()])
                ids = [list(map(int, joined.split(" "))) for joined, _ in rows]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text`` for ids of any origin; null ids count as none, ids outside the vocabulary are an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            rows = [[i for i in ids or () if i is not None] for ids in batch.column("ids").to_pylist()]
            text = [own.decode(ids) for ids in rows]
            for mine, other in zip(text, own.library.decode(rows, num_threads=1) if rows else (), strict=True):
                if mine != other:
                    raise AssertionError(f"decoded to {mine!r}, but the library has {other!r}")
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(text, pa.string())], ["id", "text"])

    source = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return source.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of every whole text, as ``encode`` and ``decode`` give them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for whole in batches:
            for batch in slices(whole, "text"):
                n, ids, text = [], [], []
                for joined, decoded in own.encode_joined([t or "" for t in batch.column("text").to_pylist()]):
                    n.append(joined.count(" ") + 1)
                    ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    text.append(hashlib.sha256(decoded.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed(
        "id", id_col
    )
