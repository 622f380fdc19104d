"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

A text becomes marked words: spaces are written as marks, and a word starts with the marks before it. The distinct
words of a batch are sorted, which walks their trie depth first: the forward table of the prefix that a word shares
with the one before it is kept, and only the rest of the word is searched.

For a unigram vocabulary the table holds the best score of each prefix and the last piece on the way to it. For a
merge-order (BPE) vocabulary pieces are not additive: there an edge is admissible if merging its piece and the one
before it, alone, leaves both as they are, and exactly one chain of admissible edges reaches each prefix, the one that
merging gives. Characters that no piece has fall back to bytes.
"""

from __future__ import annotations

import gc
import heapq
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.common import small_batches

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
CACHE_WORDS, CACHE_PAIRS, PART_CHARS = 250_000, 500_000, 1_000_000
CHARACTER, SIDE = 1 << 20, 22  # numbers of characters without a piece lie above those of pieces; bits of a number
UNIGRAM, BPE = 1, 2


@dataclass
class Vocabulary:
    """kind: UNIGRAM or BPE; ids and scores of the pieces; bytes: ids of the byte pieces, if there are any."""

    kind: int
    ids: dict[str, int]
    scores: dict[str, float]
    bytes: list[int]
    unknown: int
    spellings: list[bytes]
    dummy_prefix: bool = True
    endings: dict[str, int] = field(default_factory=dict)  # of the pieces; 0, or the id and one more of those that are pieces
    packed: dict[str, bytes] = field(default_factory=dict)  # ids of the pieces as 32-bit numbers
    pairs: dict[int, bool] = field(default_factory=dict)  # of two numbers: whether an edge is admissible
    words: dict[str, bytes] = field(default_factory=dict)
    share: float = 1.0  # of CACHE_WORDS, CACHE_PAIRS and PART_CHARS that this one keeps and takes: less memory, more work

    def __post_init__(self):
        self.packed = {p: np.uint32(i).tobytes() for p, i in self.ids.items()}
        self.endings = dict.fromkeys((p[i:] for p in self.ids for i in range(len(p))), 0) | {p: i + 1 for p, i in self.ids.items()}
        self.lowest = min(self.scores.values(), default=0.0) - 10.0


def load(model_file: str = MODEL, share: float = 1.0) -> Vocabulary:
    """Reads a model file of the driver whose normalizer leaves texts as they are; others raise."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    if not os.path.isfile(model_file):
        raise FileNotFoundError(f"{model_file}: the vocabulary must lie here on the driver, or load() be given another")
    model = pb.ModelProto()
    with open(model_file, "rb") as f:
        model.ParseFromString(f.read())
    if model.trainer_spec.model_type not in (UNIGRAM, BPE) or model.normalizer_spec.name != "identity" or model.normalizer_spec.remove_extra_whitespaces:
        raise ValueError(f"{model_file}: its kind or normalizer is not supported")
    kinds = pb.ModelProto.SentencePiece
    normal = [i for i, p in enumerate(model.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
    spellings, single = [], [0] * 256
    for i, p in enumerate(model.pieces):
        if p.type == kinds.BYTE:
            single[int(p.piece[1:-1], 16)] = i
        spellings.append(bytes([int(p.piece[1:-1], 16)]) if p.type == kinds.BYTE else p.piece.replace(MARK, " ").encode() if p.type in (kinds.NORMAL, kinds.USER_DEFINED) else b" \xe2\x81\x87 " if p.type == kinds.UNKNOWN else b"")
    return Vocabulary(model.trainer_spec.model_type, {model.pieces[i].piece: i for i in normal}, {model.pieces[i].piece: model.pieces[i].score for i in normal}, single if any(single) else [], next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN), spellings, model.normalizer_spec.add_dummy_prefix, share=share)


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """Pieces that merging gives: the neighbours whose union scores best first, then those furthest left."""
    parts: list[str | None] = list(text)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[float, int, str]] = []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < len(parts) and (union := parts[i] + parts[after[i]]) in scores:
            heapq.heappush(heap, (-scores[union], i, union))

    for i in range(len(parts)):
        offer(i)
    while heap:
        _, i, union = heapq.heappop(heap)
        if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != union:
            continue
        gone = after[i]
        parts[i], parts[gone], after[i] = union, None, after[gone]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None]


def admissible(v: Vocabulary, left: str, right: str, key: int) -> bool:
    """Whether merging left + right gives left and right; key: the numbers of both."""
    if len(v.pairs) >= CACHE_PAIRS * v.share:
        v.pairs.clear()
    found = v.pairs[key] = merged(left + right, v.scores) == [left, right]
    return found


def _extend_by_merges(v: Vocabulary, word: str, start: int, lasts: list[str], numbers: list[int]) -> None:
    """Appends the last piece of each prefix of word that is longer than start, and its number."""
    endings, pairs = v.endings, v.pairs
    for end in range(start + 1, len(word) + 1):
        last, number, at = "", 0, end - 1
        while at >= 0:
            piece = word[at:end]
            whole = endings.get(piece)
            if whole or at == end - 1:
                own = whole or CHARACTER + ord(piece)
                if not at or ((before := numbers[at]) and (found if (found := pairs.get(key := before << SIDE | own)) is not None else admissible(v, lasts[at], piece, key))):
                    last, number = piece, own
                    break
            if whole is None:
                break
            at -= 1
        lasts.append(last)
        numbers.append(number)


def _extend_by_score(v: Vocabulary, word: str, start: int, lasts: list[str], best: list[float]) -> None:
    for end in range(start + 1, len(word) + 1):
        piece = word[end - 1]
        last, top = piece, best[end - 1] + v.scores.get(piece, v.lowest)
        for at in range(end - 2, -1, -1):
            whole = v.endings.get(piece := word[at:end])
            if whole and best[at] + v.scores[piece] > top:
                last, top = piece, best[at] + v.scores[piece]
            if whole is None:
                break
        lasts.append(last)
        best.append(top)


def _ids(v: Vocabulary, piece: str) -> list[int]:
    known = v.ids.get(piece)
    if known is not None:
        return [known]
    return [v.bytes[b] for b in piece.encode("utf-8", "surrogatepass")] if v.bytes else [v.unknown]


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = 0
    for x, y in zip(a, b):  # noqa: B905
        if x != y:
            break
        n += 1
    return n


def encode_words(v: Vocabulary, words: Iterable[str]) -> dict[str, bytes]:
    """Ids of each distinct word, as 32-bit numbers; words that follow each other in order share their prefix's table."""
    extend = _extend_by_merges if v.kind == BPE else _extend_by_score
    spelled = v.packed
    out, before, lasts, best = {}, "", [""], [0 if v.kind == BPE else 0.0]
    for word in sorted(set(words)):
        shared = _common(before, word)
        del lasts[shared + 1 :], best[shared + 1 :]
        extend(v, word, shared, lasts, best)
        found, end = [], len(word)
        while end:
            piece = lasts[end]
            if not piece:  # not reached as long as every prefix has its chain
                raise ValueError(f"no segmentation of {word!r}")
            found.append(spelled.get(piece) or np.array(_ids(v, piece), np.uint32).tobytes())
            end -= len(piece)
        found.reverse()
        out[word] = b"".join(found)
        before = word
    return out


def marked(v: Vocabulary, text: str) -> list[str]:
    """The marked words of a text; none of an empty one."""
    return WORD.findall((MARK if v.dummy_prefix else "") + text.replace(" ", MARK)) if text else []


def encode_batch(v: Vocabulary, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text. Words met stay known, up to CACHE_WORDS of them, then those of the texts at hand."""
    words = [marked(v, t) for t in texts]
    known, collects = v.words, gc.isenabled()
    gc.disable()  # nothing here makes cycles, and there is much to look through
    try:
        every = set().union(*words)
        new = every.difference(known)
        if len(known) + len(new) > CACHE_WORDS * v.share:
            lately = {w: known[w] for w in every - new}
            known.clear()
            known |= lately
        known |= encode_words(v, new)
        return [np.frombuffer(b"".join(map(known.__getitem__, ws)), np.uint32) for ws in words]
    finally:
        if collects:
            gc.enable()


def decode(v: Vocabulary, ids: Iterable[int]) -> str:
    """The text that ids spell, without the mark in front; bytes that are no UTF-8 become U+FFFD."""
    raw = b"".join(map(v.spellings.__getitem__, ids))
    return (raw[1:] if v.dummy_prefix and raw[:1] == b" " else raw).decode("utf-8", "replace")


def _coder(sent, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = sent.value  # a worker keeps it, and so what it has met, from task to task
        for batch in batches:
            for part in _parts(batch, max(1, int(PART_CHARS * v.share))):
                texts = part.column("text").to_pylist()
                ids = encode_batch(v, [t for t in texts if t is not None])
                known = np.array([t is not None for t in texts], bool)
                sizes = np.zeros(len(texts), np.int64)
                sizes[known] = [len(x) for x in ids]
                values = np.concatenate(ids).view(np.int32) if ids else np.empty(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values), mask=pa.array(~known))
                out = {name: part.column(name) for name in part.schema.names if name != "text"} | {"n_tokens": pa.array(sizes), "ids": lists}
                if with_text:
                    row = iter(ids)
                    out["decoded"] = pa.array([decode(v, next(row).tolist()) if k else None for k in known], pa.string())
                yield pa.RecordBatch.from_pydict(out)

    return run


def _parts(batch: pa.RecordBatch, most_chars: int) -> Iterator[pa.RecordBatch]:
    """The rows in parts of about so many characters at most, or of one row; an empty batch is one part."""
    sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    of = np.cumsum(sizes, dtype=np.int64) // most_chars
    starts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
    for a, b in zip(starts, starts[1:], strict=False):
        yield batch.slice(a, b - a)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), with_text: bool = True) -> DataFrame:
    """(*keep, n_tokens, ids[, decoded]), one row a document, in one pass and without a shuffle.

    A null text has null ids, an empty one no ids. decoded equals the text, but for marks in it, which become spaces.
    Repeated rows, null ids and any other columns do no harm; an empty table gives no row.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary, whatever the data
    kept = docs.select(*keep, F.col(text_col).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "text") + ", n_tokens long, ids array<int>" + ", decoded string" * with_text
    return kept.mapInArrow(_coder(sent, with_text), schema)
