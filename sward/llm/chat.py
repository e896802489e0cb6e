"""Chat formatting at token level.

Every role and text is encoded on its own, as ordinary text, and reserved ids that no text can produce are spliced
between them. The loss mask is the prefix sum of +1 where an assistant's text begins and -1 where it ends. Control
strings inside texts are escaped, so that the decoded conversation can be cut into turns again without ids, too.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``<|turn|>role<|text|>text<|end|>`` for every turn.

    ``others`` are control strings of other templates that are escaped as well. A control string's first character may
    not occur later in any control string, nor the escape character anywhere, so that matches never overlap and
    escaping is reversible: ``c`` + n escapes + rest becomes ``c`` + (n + 1) escapes + rest.
    """

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "<|end|>"
    others: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")
    escape_with: str = "\\"
    loss_role: str = "assistant"
    first_id: int = 50257
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        controls = (self.turn, self.text, self.end, *self.others)
        firsts = {c[0] for c in controls}
        if any(f in c[1:] for c in controls for f in firsts) or any(self.escape_with in c for c in controls):
            raise ValueError("control strings overlap, so escaping would not be reversible")
        object.__setattr__(self, "controls", controls)

    @property
    def pattern(self) -> str:
        """A control string with any number of escapes after its first character; group 1 is that character."""
        rests: dict[str, list[str]] = {}
        for c in self.controls:
            rests.setdefault(c[0], []).append(re.escape(c[1:]))
        return "|".join(f"{re.escape(f)}{re.escape(self.escape_with)}*(?:{'|'.join(r)})" for f, r in rests.items())

    def escape(self, text: str) -> str:
        return re.sub(self.pattern, lambda m: m[0][0] + self.escape_with + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return re.sub(self.pattern, lambda m: m[0][0] + m[0][2:] if m[0][1] == self.escape_with else m[0], text)

    @property
    def markers(self) -> dict[int, str]:
        return {self.first_id: self.turn, self.first_id + 1: self.text, self.first_id + 2: self.end}


#: Longest text that is given to the encoder at once; longer ones are cut, which stays lossless.
CUT = 100_000


@functools.lru_cache(maxsize=2)
def byte_encoder(ranks_path: str, pattern: str):
    """A byte-level encoder, loaded once in a Python worker. It knows no special tokens."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _encode(encoder, text: str) -> list[int]:
    ids: list[int] = []
    for at in range(0, len(text), CUT):
        ids += encoder.encode_ordinary(text[at : at + CUT])
    return ids


SEGMENT = "conv_id long, turn long, role string, text string, ids array<int>, loss array<byte>"


def _assembler(ranks_path: str, pattern: str, template: Template):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(ranks_path, pattern)
        turn, text_id, end = template.markers
        for batch in batches:
            ids, masks = [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                head = [turn, *_encode(encoder, template.escape(role)), text_id]
                body = _encode(encoder, template.escape(text))
                edges = np.zeros(len(head) + len(body) + 1, np.int8)
                if role == template.loss_role:
                    edges[len(head)] += 1
                    edges[len(head) + len(body)] -= 1
                ids.append(np.array([*head, *body, end], np.int32))
                masks.append(np.cumsum(edges, dtype=np.int8))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("conv_id", "turn", "role", "text")],
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int32), *ids]))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int8), *masks]))),
                ],
                names=["conv_id", "turn", "role", "text", "ids", "loss"],
            )

    return assemble


def format_chats(conversations: DataFrame, ranks_path: str, pattern: str, template: Template = Template()) -> DataFrame:
    """``(conv_id, position, start, ids, loss)``: the token ids and loss mask of every turn, in order.

    ``start`` is the turn's offset in its conversation's ids, the prefix sum of the lengths before it; turns of one
    conversation joined by ``position`` are the formatted conversation. Turns are ordered by ``turn`` (nulls first),
    then role and text; repeated rows stay. Null roles and texts are empty; a null ``conv_id`` is a conversation of its
    own. Other columns are not read; no rows give no rows.

    Encoding happens before the shuffle, row by row. A conversation then passes one task as a sorted stream, which may
    spill and is never held as one value, so a conversation of any length fits.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    segments = rows.mapInArrow(_assembler(ranks_path, pattern, template), SEGMENT)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.sum(F.size("ids").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return segments.select(
        "conv_id", F.row_number().over(order).alias("position"), F.coalesce(before, F.lit(0)).cast("long").alias("start"), "ids", "loss"
    )


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_ids long, n_loss_ids long"


def _reader(ranks_path: str, pattern: str, template: Template):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(ranks_path, pattern)
        turn, text_id, end = template.markers
        width = sum(map(len, template.markers.values()))
        names = [part.split()[0] for part in DIGEST.split(", ")]
        types = [pa.string() if part.endswith("string") else pa.int64() for part in DIGEST.split(", ")]
        now, open_conversation = None, False
        turns = loss = None
        sums = [0] * 5

        def digest():
            return [now, sums[0], turns.hexdigest(), sums[1], loss.hexdigest(), sums[2], sums[3], sums[4]]

        for batch in batches:
            done = []
            for conv, start, ids, mask in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "start", "ids", "loss")]):
                if not open_conversation or conv != now:
                    if open_conversation:
                        done.append(digest())
                    now, open_conversation, turns, loss, sums = conv, True, hashlib.sha256(), hashlib.sha256(), [0] * 5
                if start != sums[3] or ids[0] != turn or ids[-1] != end:
                    raise ValueError(f"conversation {conv}: turns are not contiguous at id {start}")
                cut = ids.index(text_id)
                role, text = (encoder.decode_bytes(x).decode() for x in (ids[1:cut], ids[cut + 1 : -1]))
                lost = template.unescape(encoder.decode_bytes([i for i, m in zip(ids, mask) if m]).decode())
                turns.update(f"{template.unescape(role)}\n{template.unescape(text)}\n".encode())
                loss.update(lost.encode())
                for k, more in enumerate((1, len(lost), width + len(role) + len(text), len(ids), sum(mask))):
                    sums[k] += more
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
        if open_conversation:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(digest(), types)], names=names)

    return read


def read_back(formatted: DataFrame, ranks_path: str, pattern: str, template: Template = Template()) -> DataFrame:
    """What a reader of the ids finds in each conversation: its turns, the text under the loss mask, and sizes.

    Each conversation's turns pass in order through running digests; ids that don't continue the ones before raise.
    """
    in_order = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position").select("conv_id", "start", "ids", "loss")
    return in_order.mapInArrow(_reader(ranks_path, pattern, template), DIGEST)
