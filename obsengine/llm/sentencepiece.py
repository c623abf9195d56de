"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The model file gives the pieces; nothing is trained.  Pieces live in a double-array
trie over UTF-8 bytes, built once on the driver from the model (its size is set by the
vocabulary) and sent to the tasks.  The best segmentation is the path of largest
score sum; a character that no piece covers costs the lowest score less a penalty and
becomes its byte pieces (or the unknown piece).

Scores are log probabilities.  A unigram model states them; a model of merge ranks
states only the order of its pieces, so ``log_scores`` gives the piece of rank r the
probability that Zipf's law has for it, 1 / (r * H) with H the sum of 1 / r, its logarithm
rounded to 1/64, which keeps sums exact in single precision and ties true ties.  Other
kinds of model are refused.

Spaces become the whitespace marker, a marker is put in front, and decoding turns
markers back into spaces and byte pieces into bytes.  If no piece holds a marker
behind another character, the best path never crosses the start of a word, so words
are solved apart and remembered (``MEMORY_BYTES`` a task); otherwise the text is solved as
a whole.

The new words of about ``CHUNK_CHARS`` of text are solved together, position by position
over arrays; longer texts and words go through one by one.  Tokens leave with the
chunk that they come from, so a task holds one chunk, or one text, and its tokens besides
Spark's input batch.

Defined cases: a null or empty text has no tokens and decodes to the empty text;
white space is kept as it is; a text with the marker character itself decodes to
spaces there (``round_trip`` false); equal scores keep the path found first;
repeated rows encode alike; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import body

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
LOWEST = float("-inf")
#: What a task's remembered words may take, the longest it remembers (in bytes), and how
#: much text is encoded together.
MEMORY_BYTES, MEMORY_WIDTH, CHUNK_CHARS = 96 << 20, 64, 1 << 20
#: Kinds of model in the model format.
UNIGRAM_MODEL, RANK_MODEL = 1, 2
#: Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            size = varint() if size is None else size
            yield tag >> 3, data[at:at + size]
            at += size


def read_model(data: bytes) -> dict:
    """Pieces, scores, types and the settings that encoding needs."""
    pieces, scores, types = [], [], []
    settings = {"kind": UNIGRAM_MODEL, "byte_fallback": False, "add_dummy_prefix": True, "remove_extra_whitespaces": True}
    for field, value in _fields(data):
        if field == 1:
            piece = dict(_fields(value))
            pieces.append(piece.get(1, b"").decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            types.append(piece.get(3, NORMAL))
        elif field == 2:
            trainer = dict(_fields(value))
            settings["kind"] = trainer.get(3, UNIGRAM_MODEL)
            settings["byte_fallback"] = bool(trainer.get(35, 0))
        elif field == 3:
            normal = dict(_fields(value))
            settings["add_dummy_prefix"] = bool(normal.get(3, 1))
            settings["remove_extra_whitespaces"] = bool(normal.get(4, 1))
            if normal.get(2):
                raise ValueError("only models with the identity normaliser are supported")
    return {"pieces": pieces, "scores": scores, "types": types, **settings}


def log_scores(model: dict) -> dict:
    """The model with log probabilities as scores."""
    if model["kind"] == UNIGRAM_MODEL:
        return model
    if model["kind"] != RANK_MODEL:
        raise ValueError("neither log scores nor merge ranks in this kind of model")
    normal = [i for i, kind in enumerate(model["types"]) if kind == NORMAL]
    normal.sort(key=lambda i: -model["scores"][i])  # stable: equal scores keep their order
    rank = np.arange(1, len(normal) + 1)
    logs = (np.round(64 * (-np.log(rank) - np.log((1 / rank).sum()))) / 64).tolist()
    scores = list(model["scores"])
    for i, score in zip(normal, logs, strict=True):
        scores[i] = score
    return {**model, "scores": scores, "kind": UNIGRAM_MODEL}


def double_array(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base, check, value`` of a trie: the child of node s over byte c is
    ``base[s] + c + 1`` if ``check`` there is s; ``value`` is a key's number or -1."""
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for key, number in keys:
        node = 0
        for c in key:
            after = children[node].get(c)
            if after is None:
                after = children[node][c] = len(children)
                children.append({})
            node = after
        ends[node] = number
    size = 2 * len(children) + 1024
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    free, last, queue = 257, 257, [(0, 0)]
    for node, slot in queue:
        value[slot] = ends.get(node, -1)
        codes = sorted(c + 1 for c in children[node])
        if not codes:
            base[slot] = 0
            continue
        while check[free] >= 0:
            free += 1
        # Wide nodes look for room near the end only: the holes further down suit narrow ones.
        start = max(free - codes[0] if len(codes) < 2 else max(free, last - 256) - codes[0], 0)
        while True:
            if start + 300 >= len(check):
                for column, empty in ((base, 0), (check, -1), (value, -1)):
                    column.extend([empty] * len(column))
            if all(check[start + c] < 0 for c in codes):
                break
            start += 1
        base[slot] = start
        last = max(last, start + codes[-1])
        for c in codes:
            check[start + c] = slot
            queue.append((children[node][c - 1], start + c))
    used = max(i for i, c in enumerate(check) if c >= 0) + 300
    return tuple(np.array((column + [empty] * 300)[:used], np.int32)
                 for column, empty in ((base, 0), (check, -1), (value, -1)))


def build(model: dict) -> dict:
    """The model with its trie, ready for ``Tokenizer``."""
    scores, types = list(model["scores"]), model["types"]
    normal = [s for s, t in zip(scores, types, strict=True) if t == NORMAL]
    low, high = min(normal, default=0.0), max(normal, default=0.0)
    keys = []
    for i, (piece, kind) in enumerate(zip(model["pieces"], types, strict=True)):
        if kind in (NORMAL, USER_DEFINED) and piece:
            if kind == USER_DEFINED:
                scores[i] = len(piece.encode()) * high - 0.1
            keys.append((piece.encode(), i))
    base, check, value = double_array(keys)
    return {**model, "scores": scores, "unknown_score": low - UNKNOWN_PENALTY,
            "base": base, "check": check, "value": value,
            "crosses": any(re.search(f"[^{MARK}]{MARK}", model["pieces"][i]) for _, i in keys)}


class Tokenizer:
    """Encodes and decodes with a built model; one per task."""

    def __init__(self, model: dict) -> None:
        self.base, self.check, self.value = (model[k].tolist() for k in ("base", "check", "value"))
        self.pieces, self.types = model["pieces"], model["types"]
        # a node's child over byte c stands at base + c; the score of the piece that ends there
        self.base = [b + 1 for b in self.base]
        self.gain = [model["scores"][v] if v >= 0 else None for v in self.value]
        self.tables = [model[k] for k in ("base", "check", "value")] + [np.array(model["scores"], np.float64)]
        self.longest = max((len(p.encode()) for p in self.pieces), default=1)
        self.unknown_score, self.prefix = model["unknown_score"], model["add_dummy_prefix"]
        self.squeeze = model["remove_extra_whitespaces"]
        self.unknown = self.types.index(UNKNOWN)
        self.bytes = {int(p[1:-1], 16): i for i, (p, t) in
                      enumerate(zip(self.pieces, self.types, strict=True)) if t == BYTE}
        self.fallback = model["byte_fallback"] and len(self.bytes) == 256
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.words = None if model["crosses"] else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        # words met lately and before; the older half goes when the newer one is full
        self.memory: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.memory_bytes = 0
        # what a piece reads as; None where bytes or marks need more than that
        self.plain = [p if t in (NORMAL, USER_DEFINED, UNUSED) else None
                      for p, t in zip(self.pieces, self.types, strict=True)]

    def best_path(self, text: str) -> tuple[int, ...]:
        """Piece numbers of the best segmentation of one word or text."""
        data = text.encode("utf-8", "replace")
        base, check, gain, value = self.base, self.check, self.gain, self.value
        n = len(data)
        total = [LOWEST] * (n + 1)
        came: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        total[0] = 0.0
        at = 0
        while at < n:
            lead = data[at]
            whole = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            here, single = total[at], False
            node, end = 0, at
            for code in data[at:at + self.longest]:
                after = base[node] + code
                if check[after] != node:
                    break
                node = after
                end += 1
                score = gain[node]
                if score is not None:
                    score += here
                    if score > total[end]:
                        total[end], came[end] = score, (at, value[node])
                    if end == whole:
                        single = True
            if not single:
                score = here + self.unknown_score
                if score > total[whole]:
                    total[whole], came[whole] = score, (at, -1)
            at = whole
        path, end = [], n
        while end:
            start, piece = came[end]
            if piece >= 0:
                path.append(piece)
            elif self.fallback:
                path += [self.bytes[b] for b in reversed(data[start:end])]
            elif not path or path[-1] != self.unknown:
                path.append(self.unknown)
            end = start
        return tuple(reversed(path))

    def best_paths(self, words: list[str]) -> list[tuple[int, ...]]:
        """``best_path`` of many short words at once: every step is taken by all of them."""
        base, check, value, scores = self.tables
        coded = [w.encode("utf-8", "replace") for w in words]
        size = np.array([len(c) for c in coded])
        width = int(size.max(initial=0))
        data = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in coded), np.uint8).reshape(len(words), width)
        total = np.full((len(words), width + 1), LOWEST)
        start = np.zeros((len(words), width + 1), np.int32)
        piece = np.full((len(words), width + 1), -1, np.int32)
        total[:, 0] = 0.0
        for at in range(width):
            lead = data[:, at]
            rows = np.flatnonzero((size > at) & ((lead & 0xC0) != 0x80))
            lead = lead[rows]
            whole = at + 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
            single = np.zeros(len(rows), bool)
            live, node = np.arange(len(rows)), np.zeros(len(rows), np.int64)
            for end in range(at, min(width, at + self.longest)):
                inside = size[rows[live]] > end
                live, node = live[inside], node[inside]
                after = base[node] + data[rows[live], end] + 1
                found = check[after] == node
                live, node = live[found], after[found]
                if not len(live):
                    break
                number = value[node]
                here = number >= 0
                single[live[here & (whole[live] == end + 1)]] = True
                self._reach(total, start, piece, rows[live[here]], at, end + 1, scores[number[here]], number[here])
            for end in np.unique(whole[~single]):
                lost = rows[~single & (whole == end)]
                self._reach(total, start, piece, lost, at, end, self.unknown_score, -1)
        # back from the ends; words with a character of no piece are spelled one by one
        at, back, odd = size.copy(), [], np.zeros(len(words), bool)
        every = np.arange(len(words))
        while at.any():
            step = np.where(at > 0, piece[every, at], -2)
            odd |= step == -1
            back.append(step)
            at = np.where(at > 0, start[every, at], 0)
        paths = np.stack(back[::-1], 1).tolist() if back else [[] for _ in words]
        return [self.best_path(w) if o else tuple(x for x in path if x != -2)
                for w, o, path in zip(words, odd.tolist(), paths, strict=True)]

    @staticmethod
    def _reach(total, start, piece, rows, at, end, score, number) -> None:
        """Note a better way of the given rows to ``end`` from ``at``."""
        score = total[rows, at] + score
        better = score > total[rows, end]
        rows = rows[better]
        total[rows, end], start[rows, end] = score[better], at
        piece[rows, end] = number[better] if isinstance(number, np.ndarray) else number

    def remember(self, word: str, path: tuple[int, ...]) -> None:
        if self.memory_bytes > MEMORY_BYTES // 2:
            self.older, self.memory, self.memory_bytes = self.memory, {}, 0
        self.memory[word] = path
        self.memory_bytes += 200 + 2 * len(word) + 8 * len(path)

    def of_word(self, word: str) -> tuple[int, ...]:
        known = self.memory.get(word)
        if known is None:
            known = self.older.get(word) or self.best_path(word)
            if len(word) <= MEMORY_WIDTH:
                self.remember(word, known)
        return known

    def marked(self, text: str | None) -> str:
        text = text or ""
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        return (MARK if self.prefix else "") + text.replace(" ", MARK) if text else ""

    def encode_into(self, text: str | None, ids: array) -> None:
        """Append the tokens of the text to ``ids``."""
        marked = self.marked(text)
        if self.words is None:
            ids.extend(self.best_path(marked))
            return
        for found in self.words.finditer(marked):
            ids.extend(self.of_word(found[0]))

    def encode_many(self, texts: list[str | None]) -> tuple[array, list[int]]:
        """Tokens of all texts, and where each text's tokens end."""
        ids, ends = array("i"), []
        if self.words is None or sum(len(t or "") for t in texts) > 2 * CHUNK_CHARS:
            for text in texts:
                self.encode_into(text, ids)
                ends.append(len(ids))
            return ids, ends
        words = [self.words.findall(self.marked(t)) for t in texts]
        short, paths = [], {}
        for w in {w for x in words for w in x}:
            known = self.memory.get(w)
            if known is None and (known := self.older.get(w)) is not None:
                self.remember(w, known)
            if known is not None:
                paths[w] = known
            elif len(w) > MEMORY_WIDTH // 4:
                paths[w] = self.of_word(w)
            else:
                short.append(w)
        for w, path in zip(short, self.best_paths(short), strict=True):
            paths[w] = path
            self.remember(w, path)
        of = paths.__getitem__
        for x in words:
            ids.extend(chain.from_iterable(map(of, x)))
            ends.append(len(ids))
        return ids, ends

    def encode(self, text: str | None) -> np.ndarray:
        ids = array("i")
        self.encode_into(text, ids)
        return np.array(ids, np.int32)

    def decode(self, ids) -> str:
        out = list(map(self.plain.__getitem__, ids))
        if None in out:
            out = self._spelled(ids)
        text = "".join(out).replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def _spelled(self, ids) -> list[str]:
        """The pieces with bytes joined to characters, without control pieces."""
        out, held = [], bytearray()
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                held.append(byte)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            kind = self.types[i]
            if kind == UNKNOWN:
                out.append(" ⁇ ")
            elif kind != CONTROL:
                out.append(self.pieces[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        return out


def encode_documents(docs: DataFrame, model_path: str = MODEL, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids, round_trip`` per document: the tokens of the whole
    text, and whether decoding them gives the text back."""
    with open(model_path, "rb") as f:
        model = build(log_scores(read_model(f.read())))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(sent.value)
        for batch in batches:
            column, at = batch.column(1), 0
            while at < len(column):
                first, texts, held = at, [], 0
                while at < len(column) and (not texts or held + len(column[at].as_py()) <= CHUNK_CHARS):
                    texts.append(column[at].as_py())
                    held += len(texts[-1])
                    at += 1
                ids, ends = tokenizer.encode_many(texts)
                stops = np.array([0, *ends], np.int32)
                same = [tokenizer.decode(ids[i:j]) == t for i, j, t in zip(stops, ends, texts, strict=False)]
                flat = pa.Array.from_buffers(pa.int32(), len(ids), [None, pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(texts)), pa.array(np.diff(stops).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(stops), flat), pa.array(same, pa.bool_()),
                ], names=[id_col, "n_tokens", "ids", "round_trip"])

    return docs.select(F.col(id_col), body(text_col).alias("text")).mapInArrow(
        tokens, f"`{id_col}` {id_type}, n_tokens bigint, ids array<int>, round_trip boolean")
