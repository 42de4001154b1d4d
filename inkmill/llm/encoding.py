"""Problem 7: byte-level BPE ids of a whole corpus, by a pair occurrence index."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: The default place of the public vocabulary; a parameter of every operator here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the pattern that splits text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters encoded together; a longer text is encoded alone and whole.
CHUNK = 5_000_000

_NONE = 65535  # no token and no rank


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: printable Latin-1 stays, the others follow from 256."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


def load_vocabulary(path: str) -> dict[str, np.ndarray]:
    """Arrays of the merges in a tokenizer JSON: about 1 MB, whatever the corpus."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left = np.array([vocab[x] for x, _ in pairs], np.int64)
    right = np.array([vocab[y] for _, y in pairs], np.int64)
    made = np.array([vocab[x + y] for x, y in pairs], np.int64)
    if len(vocab) > _NONE or len(pairs) >= _NONE:
        raise ValueError("the vocabulary must have fewer than 65535 tokens")
    keys = (left << 16 | right).astype(np.uint32)
    order = np.argsort(keys, kind="stable")
    return {
        "left": left.astype(np.uint16), "right": right.astype(np.uint16), "made": made.astype(np.uint16),
        "keys": keys[order], "ranks": order.astype(np.uint16), "bytes": np.array([vocab[c] for c in byte_letters()], np.uint16),
    }


class PairIndex:
    """Applies merges to all words of a chunk at once.

    Every pair of neighbouring tokens that has a rank is kept in an index from rank to positions.  Ranks that occur are
    taken in ascending order; all positions of a rank merge together, and the pairs that arise to their left and right
    go to the lists of their ranks, which are always higher, because a token's own merge precedes its use.
    """

    def __init__(self, v: dict[str, np.ndarray]):
        self.v = v
        table = np.full((256, 256), _NONE, np.uint16)
        byte_of = {int(t): b for b, t in enumerate(v["bytes"])}
        for r, (x, y) in enumerate(zip(v["left"].tolist(), v["right"].tolist())):
            if x in byte_of and y in byte_of:
                table[byte_of[x], byte_of[y]] = r
        self.first = table.ravel()
        self.split = regex.compile(PATTERN).findall

    def merge(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Token at each byte of data after all merges, 65535 where a byte was taken in; words begin at starts."""
        v, n = self.v, len(data)
        left, right, made, keys, ranks = v["left"], v["right"], v["made"], v["keys"], v["ranks"]
        tok = np.empty(n + 1, np.uint16)
        tok[:n] = v["bytes"][data]
        tok[n] = _NONE
        nxt = np.arange(1, n + 2, dtype=np.int32)
        prv = np.arange(-1, n, dtype=np.int32)
        nxt[starts[1:] - 1] = n
        nxt[n - 1 :] = n
        prv[starts] = n
        rank = np.full(n, _NONE, np.uint16)
        rank[:-1] = self.first[data[:-1].astype(np.int32) * 256 + data[1:]]
        rank[starts[1:] - 1] = _NONE
        at = np.flatnonzero(rank != _NONE).astype(np.int32)
        rank = rank[at]
        at = at[np.argsort(rank, kind="stable")]
        present, counts = np.unique(rank, return_counts=True)
        index: dict[int, list[np.ndarray]] = {}
        stop = 0
        for r, c in zip(present.tolist(), counts.tolist()):
            index[r] = [at[stop : stop + c]]
            stop += c
        del rank, at
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            pos = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b, c = left[r], right[r], made[r]
            nx = nxt[pos]
            ok = (tok[pos] == a) & (tok[nx] == b)
            pos = pos[ok]
            if not len(pos):
                continue
            if a == b:  # in a run of equal tokens every second pair merges, from the left
                pos.sort()
                linked = np.empty(len(pos), bool)
                linked[0] = False
                linked[1:] = prv[pos[1:]] == pos[:-1]
                order = np.arange(len(pos))
                begin = np.maximum.accumulate(np.where(linked, 0, order))
                pos = pos[(order - begin) % 2 == 0]
                nx = nxt[pos]
            else:
                nx = nx[ok]
            after = nxt[nx]
            tok[pos] = c
            tok[nx] = _NONE
            nxt[pos] = after
            prv[after] = pos
            before = prv[pos]
            there = (before != n) & (tok[before] != c)
            before = before[there]
            has = after != n
            follow = pos[has]
            key = np.concatenate([tok[before].astype(np.uint32) << 16 | np.uint32(c), np.uint32(c) << 16 | tok[after[has]].astype(np.uint32)])
            where = np.searchsorted(keys, key)
            where[where == len(keys)] = 0
            hit = keys[where] == key
            if not hit.any():
                continue
            new = np.concatenate([before, follow])[hit]
            rk = ranks[where[hit]]
            if len(rk) > 1:
                o = np.argsort(rk, kind="stable")
                rk, new = rk[o], new[o]
                edges = np.flatnonzero(rk[1:] != rk[:-1]) + 1
                groups = zip(rk[np.concatenate([[0], edges])].tolist(), np.split(new, edges)) if len(edges) else [(int(rk[0]), new)]
            else:
                groups = [(int(rk[0]), new)]
            for g, places in groups:
                if g in index:
                    index[g].append(places)
                else:
                    index[g] = [places]
                    heapq.heappush(heap, g)
        return tok[:n]

    def encode(self, texts: list[str | None], counts_only: bool = False) -> tuple[np.ndarray | None, np.ndarray]:
        """Flat ids of all texts (none if counts_only) and the number of ids of each."""
        words: list[str] = []
        sizes = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                found = self.split(t)
                words += found
                sizes[i] = len(found)
        if not words:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        coded = pa.array(words, pa.large_string()).dictionary_encode()  # each distinct word is merged once
        del words
        code = coded.indices.to_numpy()
        _, offsets, raw = coded.dictionary.buffers()
        bounds = np.frombuffer(offsets, np.int64)[: len(coded.dictionary) + 1]
        starts = bounds[:-1]
        data = np.frombuffer(raw, np.uint8)[: bounds[-1]]
        tok = self.merge(data, starts)
        alive = tok != _NONE
        per_word = np.add.reduceat(alive, starts, dtype=np.int64)
        per_code = per_word[code]
        ends = np.concatenate([[0], np.cumsum(per_code)])
        upto = np.cumsum(sizes)
        per_text = ends[upto] - ends[upto - sizes]
        if counts_only:
            return None, per_text
        ids = tok[alive]
        first = np.zeros(len(per_word), np.int64)
        np.cumsum(per_word[:-1], out=first[1:])
        flat = np.repeat(first[code] - ends[:-1], per_code) + np.arange(ends[-1])
        return ids[flat].astype(np.int32), per_text


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Rows of the batch in parts of about CHUNK characters."""
    ids, texts = batch.column(0), batch.column(1).to_pylist()
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > CHUNK:
            yield ids.slice(begin, i - begin), texts[begin:i]
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield ids.slice(begin), texts[begin:]


def encode_texts(df: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, ids ARRAY<INT>) of each row: the text's ids, special strings being ordinary text.

    Null and empty texts give an empty list, blank text is encoded as it is.  Row-local: no shuffle; the merges, about
    1 MB, are broadcast, so that executors need no vocabulary file.  Rows repeated in the input come out repeated.
    """
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            coder = coder or PairIndex(shared.value)
            for ids, texts in _chunks(batch):
                flat, sizes = coder.encode(texts)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[id_col, "ids"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def count_tokens(df: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, tokens LONG) of each row, by the same index without carrying ids."""
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            coder = coder or PairIndex(shared.value)
            for ids, texts in _chunks(batch):
                _, sizes = coder.encode(texts, counts_only=True)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes)], names=[id_col, "tokens"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, tokens long")
