"""SentencePiece ids of texts, by a Viterbi pass that words with common prefixes share.

White space becomes part of the word after it, and no piece crosses such a mark, so a text's
ids are those of its marked words. Distinct words are visited in sorted order, which is a
depth-first walk of their trie: the forward scores of the prefix a word shares with the one
before are kept, and only the rest is computed.

In a merge model a piece may follow another only if merging their characters gives just these
two. With that condition on its transitions, the lattice of every prefix has one path: the one
the library's merges give. So the forward pass returns the library's ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskit.llm.common import RememberedOften, packed, small_batches, worker_state

# Fixed value of the model format: the mark for white space.
MARK = "\u2581"
_MARKED = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_CACHED_PAIRS = 200_000


class PieceModel:
    """Pieces and scores of a merge (BPE) model file."""

    def __init__(self, content: bytes):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.pieces = [model.id_to_piece(i) for i in range(len(model))]
        self.unknown = model.unk_id()
        self.bytes = {}
        self.scores: dict[str, tuple[float, int]] = {}
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.scores[piece] = (model.get_score(i), i)
        if any(MARK in p.lstrip(MARK) for p in self.scores):
            raise ValueError("a piece crosses a word mark")
        # In a merge model scores are ranks; those of a unigram model, logarithms, would give other ids.
        if any(score != int(score) for score, _ in self.scores.values()):
            raise ValueError("not a merge model")
        self.spelling = [p.encode() for p in self.pieces]
        for value, i in self.bytes.items():
            self.spelling[i] = bytes([value])
        # Every ending of a piece; the numbers of those that are pieces themselves, None for the others.
        self.endings: dict[str, int | None] = {piece[at:]: None for piece in self.scores for at in range(1, len(piece))}
        self.texts = list(self.scores)
        self.ids = [i for _, i in self.scores.values()]
        self.points = [score for score, _ in self.scores.values()]
        self.endings.update((piece, at) for at, piece in enumerate(self.texts))
        self.chains: dict[int, tuple] = {}
        self.characters: dict[str, int] = {}
        self.pairs: dict[int, bool] = {}
        self.words = RememberedOften(self.segment, np.int32, 300_000)

    def number(self, character: str) -> int:
        """A number for a character that is no piece, which others may yet merge with."""
        at = self.characters.get(character)
        if at is None:
            at = self.characters[character] = len(self.texts)
            self.texts.append(character)
            self.points.append(0.0)
        return at

    def merges(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """Parts of a short text after merging best pairs first, leftmost of equals; and of each
        merge its score and the first and the last part after it."""
        parts, scores, told = list(text), self.scores, []
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = scores.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found[0] > best):
                    best, at = found[0], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            told.append((best, parts[0], parts[-1]))
        return parts, told

    def chain(self, piece: int) -> tuple[bool, list[tuple[float, str, str]]]:
        """Whether a piece's characters merge to it, and by which merges; worked out once a piece."""
        found = self.chains.get(piece)
        if found is None:
            parts, told = self.merges(self.texts[piece])
            found = self.chains[piece] = len(parts) == 1, told
        return found

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether merging the characters of two pieces together ends with these two.

        The merges of each go their own way until a merge takes the last part of ``a`` and the first
        part of ``b`` together, which happens if it is better than the next merge of either.
        """
        (whole, left), (other, right) = self.chain(a), self.chain(b)
        if not (whole and other):
            return False
        scores, i, j = self.scores, 0, 0
        last, first = self.texts[a][-1], self.texts[b][0]
        cross = scores.get(last + first)
        while True:
            x = left[i][0] if i < len(left) else None
            y = right[j][0] if j < len(right) else None
            if cross is not None and (x is None or cross[0] > x) and (y is None or cross[0] >= y):
                return False
            if x is None and y is None:
                return True
            if y is None or (x is not None and x >= y):
                part = left[i][2]
                i += 1
                if part != last:
                    last = part
                    cross = scores.get(last + first)
            else:
                part = right[j][1]
                j += 1
                if part != first:
                    first = part
                    cross = scores.get(last + first)

    def apart(self, a: int, b: int) -> bool:
        """:meth:`stay_apart`, remembered for a bounded number of pairs; the older half goes first."""
        key = a << 32 | b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= _CACHED_PAIRS:
                for old in list(islice(self.pairs, _CACHED_PAIRS // 2)):
                    del self.pairs[old]
            found = self.pairs[key] = self.stay_apart(a, b)
        return found

    def segment(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        order = sorted(range(len(words)), key=words.__getitem__)
        out: list[list[int]] = [[]] * len(words)
        find, points, remembered, apart, chain = self.endings.get, self.points, self.pairs.get, self.apart, self.chain
        # By end of prefix: score of the path, where its last piece starts, and that piece.
        totals, starts, owns, last = [0.0], [0], [-1], ""
        for at in order:
            word = words[at]
            n, shared = len(word), 0
            for a, b in zip(word, last):
                if a != b:
                    break
                shared += 1
            del totals[shared + 1 :], starts[shared + 1 :], owns[shared + 1 :]
            for end in range(shared + 1, n + 1):
                for start in range(end - 1, -1, -1):
                    own = find(word[start:end], -1)
                    if own is None:
                        continue
                    if own < 0:  # then nothing longer ends a piece either
                        start = -1
                        break
                    before = owns[start]
                    if before < 0:
                        fits = chain(own)[0]
                    else:
                        fits = remembered(before << 32 | own)
                        if fits is None:
                            fits = apart(before, own)
                    if fits:
                        # The lattice has one path: no other piece fits here.
                        break
                else:
                    start = -1
                if start < 0:
                    start, own = end - 1, self.number(word[end - 1])
                    totals.append(totals[start])
                else:
                    totals.append(totals[start] + points[own])
                starts.append(start)
                owns.append(own)
            last = word
            path, end = [], n
            while end:
                path.append(owns[end])
                end = starts[end]
            path.reverse()
            if max(path, default=0) < len(self.ids):
                out[at] = [self.ids[p] for p in path]
            else:
                out[at] = [i for p in path for i in ([self.ids[p]] if p < len(self.ids) else self.spelled(self.texts[p]))]
        return out

    def spelled(self, character: str) -> list[int]:
        """A character without a piece, as its bytes where the model has them."""
        if len(self.bytes) < 256:
            return [self.unknown]
        return [self.bytes[b] for b in character.encode()]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.marked_words(t) if t else [] for t in texts]
        ids, sizes = self.words.numbers([w for words in split for w in words])
        ends = np.append(0, np.cumsum(sizes))[np.cumsum([len(w) for w in split])] if split else []
        return np.split(ids, ends[:-1]) if split else []

    @staticmethod
    def marked_words(text: str) -> list[str]:
        marked = MARK + text.replace(" ", MARK)
        if MARK * 2 not in marked:
            return [MARK + w for w in marked[1:].split(MARK)]
        return _MARKED.findall(marked)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.spelling.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text


def _model(content: bytes, key: str) -> PieceModel:
    return worker_state(f"pieces_{key}", lambda: PieceModel(content))


def encode(docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """The rows of ``docs`` with one more column ``ids``, the pieces of ``text``.

    ``model`` is the content of a SentencePiece model file. Whole texts are encoded; null and
    empty texts have no ids. With ``decoded``, a column of that name has what the ids spell,
    from the same pass. Columns of these names are replaced. Repeated rows come back repeated,
    an empty table gives no rows. No shuffle; each task remembers a bounded number of words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one file of about a MB
    key = xxhash.xxh3_64_hexdigest(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(shared.value, key)
        for batch in small_batches(batches):
            made = pieces.encode(batch.column(1).to_pylist())
            offsets = np.append(0, np.cumsum([len(m) for m in made])).astype(np.int32)
            flat = np.concatenate(made) if made else np.empty(0, np.int32)
            spelled = [pieces.decode(m.tolist()) if decoded else None for m in made]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
                    pa.array(spelled, pa.string()),
                ],
                ["row", "ids", "decoded"],
            )

    rows = packed(docs, text=F.col(f"`{text}`"))
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    made = rows.mapInArrow(run, T.StructType([rows.schema["row"], *added]))
    kept = [c for c in docs.columns if c not in (ids, decoded)]
    back = [F.col("decoded").alias(decoded)] if decoded else []
    return made.select(*[F.col("row")[c].alias(c) for c in kept], F.col("ids").alias(ids), *back)


def decode(df: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows of ``df`` with one more column ``text``, what ``ids`` spell; null ids give null.

    Encoding and decoding give back every text but for the mark character itself, which comes
    back as a space.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # one file of about a MB
    key = xxhash.xxh3_64_hexdigest(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(shared.value, key)
        for batch in small_batches(batches):
            texts = [None if i is None else pieces.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    rows = packed(df, ids=F.col(f"`{ids}`"))
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    made = rows.mapInArrow(run, schema)
    kept = [c for c in df.columns if c != text]
    return made.select(*[F.col("row")[c].alias(c) for c in kept], F.col("text").alias(text))
