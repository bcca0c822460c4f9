"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is marked (a mark for each space, one in front) and cut into marked words, runs of marks with what follows them.
No piece of a model crosses such a cut, which is checked, so the best segmentation of a text is that of its words. The
distinct words of a batch are sorted, which lines them up as the leaves of a trie in depth-first order: a word keeps the
forward scores of the prefix it shares with the word before it and computes those of its further characters only.

The path through the lattice of pieces follows from the kind of model. Scores of a unigram model add up and the highest
sum wins; of equal sums the one whose last piece is the longest wins. Scores of a merge model are no probabilities but
the order of merges, so the path is the one on which every two pieces in a row are what merging makes of their text:
such a path is unique, and the last piece of a prefix depends on that prefix alone, as the forward scores do. Both give the
ids that the model's own library gives, which the tests hold (of paths with equal sums the library may take another, as
its sums are rounded). Characters without a piece cost the lowest score less 10
and become byte pieces where the model has them, else runs of them one unknown piece.

Decoding joins the pieces, reads runs of byte pieces as UTF-8 (bad bytes become U+FFFD), turns marks into spaces and
drops the one in front. Defined results: a null or empty text has no pieces and decodes to the empty text; a mark in the
text itself decodes to a space; lone surrogates can't occur in Spark's strings; repeated rows each get a row; an empty
table gives an empty result; clashing columns of the input are not carried. A very long text or word takes time in
proportion to its length; memory grows with the longest text, and the words remembered are bounded by `remember`.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
UNK_PENALTY = 10.0


def _fields(raw: bytes):
    """(number, value) of the fields of a protocol buffer message; numbers of fixed width are passed over."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        elif kind == 2:
            n = varint()
            yield number, raw[at : at + n]
            at += n
        else:
            at += 8 if kind == 1 else 4


# The field of a model that holds its training options, that of the kind in them, and the kind of merges.
TRAINER, KIND, MERGES = 2, 3, 2


def is_merge_model(proto: bytes) -> bool:
    trainer = next((v for n, v in _fields(proto) if n == TRAINER), b"")
    return next((v for n, v in _fields(trainer) if n == KIND), 1) == MERGES


class Pieces:
    """A model's vocabulary: plain Python values that travel in closures; its size is the model's."""

    def __init__(self, pieces: dict[str, tuple[int, float]], texts: list[str], byte_ids: list[int], unk: int, merges: bool = False):
        self.pieces, self.texts, self.byte_ids, self.unk = pieces, texts, byte_ids, unk
        self.floor = min((s for _, s in pieces.values()), default=0.0) - UNK_PENALTY
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece crosses the start of a marked word")
        self.rank = self.parts = None
        if merges:
            self.rank = {p: r for r, p in enumerate(sorted(pieces, key=lambda p: (-pieces[p][1], pieces[p][0])))}
            self.parts = {p: x for p in pieces if len(p) > 1 and (x := self._last_merge(p))}

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two symbols whose merge makes the piece; None if merging its text doesn't end with it."""
        out = list(piece)
        while len(out) > 2:
            r, i = min((self.rank.get(x + y, math.inf), i) for i, (x, y) in enumerate(zip(out, out[1:])))
            if r == math.inf:
                return None
            out[i : i + 2] = [out[i] + out[i + 1]]
        return out[0], out[1]

    def stays(self, x: str, y: str) -> bool:
        """Whether merging the text of two symbols in a row leaves the cut between them.

        Their last merges are undone, the latest first; before the next one, no merge across the cut may come first.
        """
        limit = math.inf
        while True:
            if self.rank.get(x + y, math.inf) < limit:
                return False
            rx = self.rank[x] if x in self.parts else -1
            ry = self.rank[y] if y in self.parts else -1
            if rx > ry:
                limit, x = rx, self.parts[x][1]
            elif ry >= 0:  # of two equal merges the left one comes first
                limit, y = ry + 1, self.parts[y][0]
            else:
                return True

    def trie(self) -> dict:
        """Nested: character to (characters below, id or -1, score)."""
        root: dict = {}
        for text, (i, score) in self.pieces.items():
            if self.rank is not None and len(text) > 1 and text not in self.parts:
                continue
            node = root
            for c in text[:-1]:
                node = node.setdefault(c, ({}, -1, 0.0))[0]
            node[text[-1]] = (node[text[-1]][0] if text[-1] in node else {}, i, score)
        return root

    @classmethod
    def load(cls, path: str = DEFAULT_MODEL) -> Pieces:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(m.get_piece_size())
        own = {m.id_to_piece(i): (i, m.get_score(i)) for i in ids if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))}
        byte_ids = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not m.is_byte(byte_ids[0]):
            byte_ids = []
        return cls(own, ["" if m.is_control(i) else m.id_to_piece(i) for i in ids], byte_ids, m.unk_id(), is_merge_model(m.serialized_model_proto()))


def _ids(w: str, back: list[tuple[int, int]], model: Pieces) -> list[int]:
    """Ids of a word's pieces from their starts and ids by end."""
    ids, e = [], len(w)
    while e:
        s, piece = back[e]
        if piece >= 0:
            ids.append(piece)
        elif model.byte_ids:
            ids.extend(model.byte_ids[b] for b in reversed(w[s:e].encode("utf-8", "replace")))
        elif not ids or ids[-1] != model.unk:
            ids.append(model.unk)
        e = s
    ids.reverse()
    return ids


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def _by_score(words: list[str], model: Pieces, root: dict) -> Iterator[tuple[str, list[int]]]:
    """live[e]: place in the trie of pieces, and score and position of the start, of the pieces under way after e characters."""
    floor = model.floor
    live, back, before = [[(root, 0.0, 0)]], [(0, 0)], ""
    for w in words:
        same = _shared(w, before)
        del live[same + 1 :], back[same + 1 :]
        for e in range(same + 1, len(w) + 1):
            c, high, start, piece, on = w[e - 1], -math.inf, -1, -1, []
            for node, base, s in live[-1]:
                child = node.get(c)
                if child is not None:
                    below, i, score = child
                    if i >= 0 and base + score > high:
                        high, start, piece = base + score, s, i
                    if below:
                        on.append((below, base, s))
            if root.get(c, (0, -1))[1] < 0:
                base = live[-1][-1][1]
                if base + floor > high:
                    high, start, piece = base + floor, e - 1, -1
            on.append((root, high, e))
            live.append(on)
            back.append((start, piece))
        before = w
        yield w, _ids(w, back, model)


def _by_merges(words: list[str], model: Pieces, root: dict, pairs: dict[int, bool], remember: int = 100_000) -> Iterator[tuple[str, list[int]]]:
    """live[e]: place in the trie of pieces, and start, of the pieces under way after e characters."""
    live, back, before, stays, n = [[(root, 0)]], [(0, -1)], "", model.stays, len(model.texts)
    for w in words:
        same = _shared(w, before)
        del live[same + 1 :], back[same + 1 :]
        if len(pairs) > remember:
            pairs.clear()
        for e in range(same + 1, len(w) + 1):
            c, start, piece, on = w[e - 1], -1, -1, []
            for node, s in live[-1]:
                child = node.get(c)
                if child is not None:
                    below, i, _ = child
                    if i >= 0 and start < 0:
                        at, last = back[s]
                        if not s:
                            fits = True
                        elif last < 0:
                            fits = stays(w[at:s], w[s:e])
                        else:
                            fits = pairs.get(last * n + i)
                            if fits is None:
                                fits = pairs[last * n + i] = stays(w[at:s], w[s:e])
                        if fits:
                            start, piece = s, i
                    if below:
                        on.append((below, s))
            on.append((root, e))
            live.append(on)
            back.append((start, piece) if start >= 0 else (e - 1, -1))
        before = w
        yield w, _ids(w, back, model)


def segment(words: list[str], model: Pieces, root: dict | None = None, pairs: dict | None = None) -> Iterator[tuple[str, list[int]]]:
    """Words in sorted order with the ids of their pieces.

    What is known of a prefix, the pieces under way and the last piece, depends on the prefix alone, so a word goes on
    from the prefix that it shares with the word before it. pairs remembers which pieces of a merge model can follow
    each other.
    """
    root = root or model.trie()
    if model.rank is None:
        return _by_score(sorted(words), model, root)
    return _by_merges(sorted(words), model, root, {} if pairs is None else pairs)


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


class Encoder:
    """Encodes batches of texts; remembers words up to `remember` of them."""

    def __init__(self, model: Pieces, remember: int = 1_000_000, long_word: int = 64, together: int = 6_000_000):
        self.model, self.remember, self.long_word, self.together, self.known = model, remember, long_word, together, {}
        self.root, self.pairs = model.trie(), {}

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        at = 0
        while at < len(texts):  # texts of some megabytes together: the more words, the more they share
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) < self.together):
                size += len(texts[to])
                to += 1
            cut = [_WORD.findall(marked(t)) for t in texts[at:to]]
            at = to
            new = {w for words in cut for w in words if w not in self.known}
            if len(self.known) + len(new) > self.remember:
                self.known = {}
                new = {w for words in cut for w in words}
            for w, ids in segment(list(new), self.model, self.root, self.pairs):
                self.known[w] = np.array(ids, dtype="<i4").tobytes()
            for words in cut:
                yield np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype="<i4")
            for w in [w for w in new if len(w) > self.long_word]:
                del self.known[w]


class Decoder:
    def __init__(self, model: Pieces):
        self.texts = np.array(model.texts, dtype=object)
        self.byte = np.full(len(model.texts), -1, dtype=np.int64)
        for b, i in enumerate(model.byte_ids):
            self.byte[i] = b

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        parts, byte = self.texts[ids], self.byte[ids]
        at = np.flatnonzero(byte >= 0)
        if len(at):
            runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)
            for run in runs:
                parts[run] = ""
                parts[run[0]] = byte[run].astype(np.uint8).tobytes().decode("utf-8", "replace")
        out = "".join(parts.tolist()).replace(MARK, " ")
        return out[1:] if out.startswith(" ") else out


def encode(docs: DataFrame, model: Pieces, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, remember: int = 1_000_000, together: int = 6_000_000) -> DataFrame:
    """doc_id, n_pieces, n_bytes, ids_sha256 (little-endian 32-bit ids), round_trip and, if wanted, ids.

    A worker remembers `remember` words and cuts texts of about `together` characters at once; both bound its memory only.
    """
    byte_ids = set(model.byte_ids)

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, dec = Encoder(model, remember, together=together), Decoder(model)
        is_byte = np.zeros(len(model.texts), dtype=bool)
        is_byte[list(byte_ids)] = True
        for b in batches:
            texts = [t or "" for t in b["text"]]
            rows, held, names = [], 0, b["doc_id"]
            for i, (g, t) in enumerate(zip(enc.encode(texts), texts)):
                rows.append((len(g), int(is_byte[g].sum()), hashlib.sha256(g.tobytes()).hexdigest(), dec.decode(g) == t.replace(MARK, " "), *[g] * ids))
                held += len(g)
                if held >= 500_000 or i == len(texts) - 1:
                    out = pd.DataFrame({"doc_id": names.iloc[i + 1 - len(rows) : i + 1].array})
                    for j, name in enumerate(("n_pieces", "n_bytes", "ids_sha256", "round_trip", "ids")[: 4 + ids]):
                        out[name] = pd.Series([r[j] for r in rows], dtype=("int64", "int64", object, bool, object)[j])
                    yield out
                    rows, held = [], 0

    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, n_pieces long, n_bytes long, ids_sha256 string, round_trip boolean{', ids array<int>' * ids}"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(go, schema)


def decode(encoded: DataFrame, model: Pieces, ids_col: str = "ids") -> DataFrame:
    """encoded with its texts in the column text; null ids give a null text."""

    @F.pandas_udf("string")
    def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dec = Decoder(model)
        for p in parts:
            yield pd.Series([None if x is None else dec.decode(np.asarray(x, dtype=np.int64)) for x in p], dtype=object)

    return encoded.withColumn("text", text(F.col(ids_col)))


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), Pieces.load(), ids=False)
