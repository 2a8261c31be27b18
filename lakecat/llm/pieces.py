"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three transducers are compiled from a model: the normaliser (the longest string of the model's character map at a place becomes
its image, runs of spaces are folded where the model says so, a space becomes the visible space, a text begins with one), the closure of the pieces (each an arc from its characters to its id, at
the cost of its negative score), and byte fallback (a character without a piece becomes its UTF-8 bytes, each dearer than
any piece). Composed with a text they give a lattice over the places between its characters; its
shortest path in the tropical semiring (costs add along a path, the least counts) is the encoding. Of equally short paths
the one whose last piece is longest wins, at every place.

Where no piece holds two neighbouring characters side by side, every path passes between them. The lattice is
cut there, and the shortest paths of its parts are remembered; parts repeat from text to text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakecat.llm.common import batches, release, text_or_empty, uncollected

SPACE = "▁"  # the visible space
#: Parts whose path a worker remembers, and as many older ones, some 190 bytes each; longer parts are not remembered.
MOST_PARTS, LONGEST_PART = 150_000, 48
#: Marks by hash (a power of two) of the parts with closing punctuation seen so far: they are remembered from the second time on, without it at once.
MARKS = 1 << 21
#: Bytes of texts that are encoded at a time.
BATCH_BYTES = 1 << 20
STRETCH = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*|[^{SPACE}\n]+")
CLOSING = ".,;:!?|#%&*$)"
INFINITE = float("inf")
NEVER = 1e8  # costs from here on mark pieces that a model only keeps to name them


def character_map(compiled_map: bytes) -> dict[str, str]:
    """The strings that a model's character map replaces, and what by.

    The map is a double-array trie of 32-bit units over UTF-8 bytes, behind its size, and then the images, each ended by a zero
    byte, at the places that the trie gives.
    """
    if not compiled_map:
        return {}
    size = int.from_bytes(compiled_map[:4], "little")
    units = np.frombuffer(compiled_map, "<u4", size // 4, 4).astype(np.int64)
    images, out = compiled_map[4 + size:], {}
    labels = np.arange(1, 256)

    def base(at: int) -> int:
        unit = int(units[at])
        return at ^ (unit >> 10 << ((unit & 512) >> 6))

    stack = [(0, b"")]
    while stack:
        at, found = stack.pop()
        first = base(at)
        if found and int(units[at]) >> 8 & 1:
            start = int(units[first]) & 0x7FFFFFFF
            out[found.decode()] = images[start:images.index(b"\0", start)].decode()
        below = first ^ labels
        there = below < len(units)
        for label in labels[there][(units[below[there]] & 0x800000FF) == labels[there]].tolist():
            stack.append((first ^ label, found + bytes([label])))
    return out


class Normaliser:
    """What a model does to a text before pieces are looked for, as a transducer from characters to characters."""

    def __init__(self, spec):
        self.images = character_map(spec.precompiled_charsmap)
        self.folds, self.prefix = spec.remove_extra_whitespaces, SPACE if spec.add_dummy_prefix else ""
        self.longest: dict[str, int] = {}
        for found in self.images:
            self.longest[found[0]] = max(self.longest.get(found[0], 0), len(found))
        # The places at which the map may say something.
        self.may = re.compile("[" + re.escape("".join(sorted(self.longest))) + "]") if self.longest else None

    def mapped(self, text: str) -> str:
        """The text with the longest strings of the map replaced, from left to right."""
        out, last, found = [], 0, self.may.search(text)
        while found:
            at = end = found.start()
            for n in range(self.longest[text[at]], 0, -1):
                if (image := self.images.get(text[at:at + n])) is not None:
                    out += [text[last:at], image]
                    last = end = at + n
                    break
            found = self.may.search(text, max(end, at + 1))
        return "".join(out) + text[last:]

    def __call__(self, text: str) -> str:
        if self.may:
            text = self.mapped(text)
        if self.folds:
            text = " ".join([x for x in text.split(" ") if x])
        return self.prefix + text.replace(" ", SPACE) if text else ""


class Transducer:
    """The composed transducers of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = SentencePieceProcessor(model_file=path)
        self.normalised = Normaliser(
            sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto()).normalizer_spec)
        self.prefix = self.normalised.prefix
        self.costs: dict[str, float] = {}
        by_id = np.zeros(model.vocab_size())
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        self.table: list[bytes] = []
        for id_ in range(model.vocab_size()):
            piece = model.id_to_piece(id_)
            if model.is_byte(id_):
                value = int(piece[3:5], 16)
                self.bytes[value] = id_
                self.table.append(bytes([value]))
            elif model.is_control(id_) or model.is_unknown(id_) or model.is_unused(id_):
                self.table.append(b"")
            else:
                self.ids[piece], self.costs[piece] = id_, -model.get_score(id_)
                self.table.append(piece.replace(SPACE, " ").encode())
        self.byte_cost = max(c for c in self.costs.values() if c < NEVER) + 10
        for piece, id_ in self.ids.items():
            by_id[id_] = self.costs[piece]
        by_id[[x for x in self.bytes if x]] = self.byte_cost
        self.by_id = by_id
        # What a stretch of characters is: None if no piece begins so, () if it only begins one, else (cost, id).
        self.arcs: dict[str, tuple] = {piece[:n]: () for piece in self.ids for n in range(1, len(piece))}
        self.arcs.update((piece, (self.costs[piece], id_)) for piece, id_ in self.ids.items())
        self.inside = {piece[i:i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        self.sizes = np.array([len(x) for x in self.table], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.bytes_of_all = np.frombuffer(b"".join(self.table), np.uint8)
        self.spans_space = any("\n" in pair or pair[0] != SPACE and pair[1] == SPACE for pair in self.inside)
        self.forget()

    def shortest(self, part: str) -> bytes:
        """The ids on the shortest path through a part's lattice."""
        get, size = self.arcs.get, len(part)
        best, back, by = [0.0] + [INFINITE] * size, [0] * (size + 1), [-1] * (size + 1)
        for at in range(size):
            here, end = best[at], at + 1
            first = arc = get(part[at:end])
            while arc is not None:
                if arc and here + arc[0] < best[end]:
                    best[end], back[end], by[end] = here + arc[0], at, arc[1]
                end += 1
                arc = get(part[at:end]) if end <= size else None
            if not first:  # no piece of this character alone: its bytes
                cost = here + self.byte_cost * len(part[at].encode())
                if cost < best[at + 1]:
                    best[at + 1], back[at + 1], by[at + 1] = cost, at, -1
        out: list[int] = []
        at = size
        while at:
            if by[at] < 0:
                out.extend(self.bytes[b] for b in reversed(part[back[at]:at].encode()))
            else:
                out.append(by[at])
            at = back[at]
        return array("i", out[::-1]).tobytes()

    def cut(self, part: str) -> list[str]:
        """A part at all places that no piece spans."""
        out, last, inside = [], 0, self.inside
        for at in range(1, len(part)):
            if part[at - 1:at + 1] not in inside:
                out.append(part[last:at])
                last = at
        out.append(part[last:])
        return out

    def path(self, part: str) -> bytes:
        """The path of any stretch of normalised text that no piece crosses the ends of.

        Closing punctuation is cut off where the lattice allows it, as words recur with and without it.
        """
        found = self.known.get(part) or self.older.get(part)
        keep = len(part) <= LONGEST_PART
        if found is None:
            core = len(part.rstrip(CLOSING))
            if 0 < core < len(part) and part[core - 1:core + 1] not in self.inside:
                found = self.path(part[:core]) + self.path(part[core:])
                mark = hash(part) & (MARKS - 1)
                keep, self.seen[mark] = keep and self.seen[mark], 1
            else:
                found = self.shortest(part)
        if keep:
            if len(self.known) >= MOST_PARTS:
                self.known, self.older, self.seen = {}, self.known, bytearray(MARKS)
            self.known[part] = found
        return found

    def stretches(self, text: str) -> list[str]:
        """A normalised text cut before line ends and runs of visible spaces, if no piece forbids it."""
        if self.spans_space:
            return self.cut(text)
        return STRETCH.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as four-byte integers."""
        out, path = [], self.path
        for text in texts:
            get = self.known.get  # of this text's beginning: parts may move to the older ones meanwhile, where `path` finds them
            out.append(b"".join([get(x) or path(x) for x in self.stretches(self.normalised(text))]))
        return out

    def forget(self) -> None:
        """Drop the paths that were kept: the worker lives on, beside the executor's next stages."""
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.seen = bytearray(MARKS)

    def cost(self, ids: bytes) -> float:
        """What the path of these ids costs."""
        return float(self.by_id[np.frombuffer(ids, "i4")].sum())

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character."""
        return self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))[0]

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of the ids between each two offsets: all their bytes are gathered at once."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.places[ids] - (ends - sizes), sizes)
        data = self.bytes_of_all[np.arange(len(shift)) + shift].tobytes()
        cuts = np.concatenate([[0], ends])[offsets].tolist()
        texts = (data[start:end] for start, end in zip(cuts, cuts[1:]))
        return [(t[1:] if self.prefix and t[:1] == b" " else t).decode(errors="replace") for t in texts]


COMPILED: dict[str, Transducer] = {}


def compiled(path: str) -> Transducer:
    if path not in COMPILED:
        COMPILED[path] = Transducer(path)
    return COMPILED[path]


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, text (if wanted), ids, cost: the encoding of every whole text; null and empty texts have no ids.

    Repeated rows and rows without a key are encoded like any other.
    """
    names = ["doc_id", *["text"] * with_text, "ids", "cost"]
    rows = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(model)
        for batch in batches(found, BATCH_BYTES):
            with uncollected():
                coded = transducer.encode(batch.column("text").to_pylist())
            values = np.frombuffer(b"".join(coded), "i4")
            ends = np.cumsum([0, *[len(ids) // 4 for ids in coded]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(names[:-2]).columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                 pa.array([transducer.cost(ids) for ids in coded], pa.float64())], names=names)
            del batch, coded, values  # not held while the next is read
        transducer.forget()
        release()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {'text string, ' * with_text}ids array<int>, cost double")


def decode(encoded: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`encoded` with the text of its ids; null ids give null."""
    kept = encoded.drop(out)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(model)
        for batch in batches(found, 2 << 20):
            lists = batch.column(ids)
            offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            texts = transducer.decode_all(lists.flatten().to_numpy(zero_copy_only=False), offsets.astype(np.int64))
            texts = [t if there else None for t, there in zip(texts, lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes)
    return kept.mapInArrow(run, f"{schema}, `{out}` string")
