"""Operator 9: chat formatting at token level.

A turn is  opening id, ids of its escaped text, closing id.  The reserved ids
lie beyond the vocabulary and are spliced in, never encoded, so no text can
produce one.  Texts are encoded apart from the markers.  Control strings in
a text are escaped, so the formatted *text* is unambiguous as well; unescaping
gives the text back.  The loss mask is a prefix sum: +1 behind an assistant's
opening id, -1 at its closing id.

Turns are formatted where they lie (one row, one turn).  Only the read-back
brings a conversation together: rows sorted by (conversation, turn) stream
through a task that holds one batch and the running digests, so a conversation
of any length needs constant memory.

Defined results: null text = empty; null role = the empty role name; roles
other than system, user, assistant carry their name in the format; null conv_id
= one conversation of its own; turns sort by number (null first), ties by role
and text; rows that repeat are turns each; only conv_id, turn, role and text
are read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikisift.llm.common import bounded_batches
from wikisift.llm.tokens import encoder

#: Markers of the template, in the order of their reserved ids.
MARKERS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[TURN]", "[/TURN]"]
OPEN = {"system": (0, 1), "user": (2, 3), "assistant": (4, 5)}
ROLE, TURN = (6, 7), (8, 9)
#: Escape character (SYMBOL FOR ESCAPE) and what stands behind it: the place of
#: the control string in this list.
ESCAPE = "␛"
CONTROL = [ESCAPE, *MARKERS]
CODES = "0123456789abcdefghijklmnopqrstuvwxyz"
_FIND = re.compile("|".join(map(re.escape, CONTROL)))
_BACK = re.compile(re.escape(ESCAPE) + "(.)", re.DOTALL)


def escape(text: str) -> str:
    return _FIND.sub(lambda m: ESCAPE + CODES[CONTROL.index(m[0])], text)


def unescape(text: str) -> str:
    return text if ESCAPE not in text else _BACK.sub(lambda m: CONTROL[CODES.index(m[1])], text)


def turn_ids(role: str, text: str, enc) -> list[np.ndarray]:
    """The segments of one turn; reserved ids start at ``enc.size``."""
    mark = lambda k: np.array([enc.size + k], np.uint32)
    words = enc.ids(escape(text))
    if role in OPEN:
        first, last = OPEN[role]
        return [mark(first), words, mark(last)]
    return [mark(ROLE[0]), enc.ids(escape(role)), mark(ROLE[1]), mark(TURN[0]), words, mark(TURN[1])]


def loss_mask(ids: np.ndarray, size: int) -> np.ndarray:
    """True on the ids between an assistant's opening and closing id."""
    first, last = (size + k for k in OPEN["assistant"])
    inside = np.cumsum(ids == first) - np.cumsum(ids == last)
    return (inside > 0) & (ids != first)


def _format(batches):
    enc = encoder()
    for b in batches:
        ids, masks, sizes = [], [], []
        for role, text in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            parts = turn_ids(role or "", text or "", enc)
            ids += parts
            sizes.append(sum(map(len, parts)))
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        mask = loss_mask(flat, enc.size)
        ends = np.cumsum(sizes, dtype=np.int64)
        offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32))),
                                          pa.ListArray.from_arrays(offsets, pa.array(mask))], ["conv_id", "turn", "role", "text", "ids", "loss"])


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, ids, loss of every row: a conversation's
    training sequence is its rows' ids in the order of :data:`ORDER`."""
    bounded_batches(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_format, "conv_id long, turn long, role string, text string, ids array<int>, loss array<boolean>")


ORDER = ["conv_id", "turn", "role", "text"]


def read_turns(ids: np.ndarray, loss: np.ndarray, enc) -> tuple[list[tuple[str, str]], str, str]:
    """(turns, formatted text, unescaped text under the mask) of formatted ids."""
    turns, shown, role = [], [], None
    cuts = np.flatnonzero(ids >= enc.size)
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        k = int(ids[a]) - enc.size
        text = enc.text(ids[a + 1 : z])
        shown += [MARKERS[k], text]
        if k == ROLE[0]:
            role = unescape(text)
        elif k == TURN[0]:
            turns.append((role, unescape(text)))
        else:
            turns += [(name, unescape(text)) for name, (first, _) in OPEN.items() if k == first]
    shown += [MARKERS[int(ids[z]) - enc.size] for z in cuts[-1:].tolist()]
    return turns, "".join(shown), unescape(enc.text(ids[loss])) if loss.any() else ""


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(batches):
    enc = encoder()

    def close(conv, s):
        return (conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4])

    now, state = None, None
    for b in batches:
        done = []
        ids, loss = b.column(1).flatten().to_numpy(), b.column(2).flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.list_value_length(b.column(1)).to_numpy())
        for conv, a, z in zip(b.column(0).to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
            if state is None or conv != now:
                if state is not None:
                    done.append(close(now, state))
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            turns, shown, masked = read_turns(ids[a:z], loss[a:z], enc)
            for role, text in turns:
                state[1].update(f"{role}\n{text}\n".encode())
            state[0] += len(turns)
            state[2] += len(masked)
            state[3].update(masked.encode())
            state[4] += len(shown)
        yield _rows(done)
    if state is not None:
        yield _rows([close(now, state)])


def _rows(done):
    cols = list(zip(*done)) if done else [[]] * 6
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from :func:`format_turns`' output."""
    bounded_batches(turns.sparkSession)
    return (turns.repartition("conv_id").sortWithinPartitions(*ORDER).select("conv_id", "ids", "loss").mapInArrow(_read_back, _READ))
