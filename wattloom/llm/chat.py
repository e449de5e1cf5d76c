"""Chat formatting by token-level assembly.

Each turn is encoded by itself, and the ids that mark turns are spliced in as reserved ids, never encoded from text. Loss masks are
prefix sums of steps at segment borders. Control strings that occur in a text are escaped first, so no text can spell a mark.

A turn is ``open text close``. The opening mark gives the role: ``[INST]`` user, ``<<SYS>>`` system, ``<s>`` assistant; any other
role is written between ``[ROLE]`` and ``[/ROLE]``. Only assistant texts are under the loss mask.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from wattloom.llm.common import workers_import

RANKS = "byte_bpe_50k.tiktoken"
FIRST_RESERVED = 50_257
#: Fixed control strings; their ids follow each other from FIRST_RESERVED.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
IDS = {c: FIRST_RESERVED + i for i, c in enumerate(CONTROLS)}
MARKS = {"assistant": ("<s>", "</s>"), "user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>")}
ROLE_OF = {IDS[opening]: role for role, (opening, _) in MARKS.items()}
LOSS_ROLE = "assistant"

_SPECIAL = re.compile("|".join([r"\\", *map(re.escape, CONTROLS)]))
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """Double every backslash and put one after the first character of every control string."""
    return _SPECIAL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text) if text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@cache
def _encoding(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def format_turns(conversations: DataFrame, tokenizer: str | None = None, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turn, role, text, input_ids, loss_mask)``, one row per turn; a conversation is its rows in order of turn, role, text.

    A null text or role is empty. Equal rows are turns of their own. Nothing is cut, whatever the length. Extra columns are
    dropped; an empty table gives an empty result. ``tokenizer`` is the path of a byte-level rank file.
    """
    workers_import(conversations.sparkSession)
    path = tokenizer or public_tokenizers.path(RANKS)
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                                F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", input_ids array<int>, loss_mask array<tinyint>"

    def assemble(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoding(path).encode_ordinary
        for frame in frames:
            lengths, steps, parts = [], [], []
            for who, said in zip(frame["role"], frame["text"], strict=True):
                opening, closing = MARKS.get(who, ("[ROLE]", "</s>"))
                before = [IDS[opening]]
                if who not in MARKS:
                    before += [*encode(escape(who)), IDS["[/ROLE]"]]
                body = encode(escape(said))
                parts.append(np.array([*before, *body, IDS[closing]], np.int32))
                lengths.append(len(parts[-1]))
                steps.append((len(before), len(before) + len(body)) if who == LOSS_ROLE else (0, 0))
            starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            change = np.zeros(starts[-1] + 1, np.int8)
            inner = np.array(steps, np.int64).reshape(-1, 2) + starts[:-1, None]
            np.add.at(change, inner[:, 0], 1)
            np.add.at(change, inner[:, 1], -1)
            mask = np.cumsum(change, dtype=np.int8)
            frame["input_ids"] = parts
            frame["loss_mask"] = [mask[a:b] for a, b in zip(starts, starts[1:], strict=False)]
            yield frame

    return rows.mapInPandas(assemble, schema)


class _Reader:
    """Reads one conversation back from its ids, turn by turn; holds digests, not texts."""

    def __init__(self, conv_id, decode):
        self.conv_id, self.decode = conv_id, decode
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = self.n_tokens = 0

    def take(self, ids: np.ndarray, mask: np.ndarray) -> None:
        marks = np.flatnonzero(ids >= FIRST_RESERVED)
        first, last = int(marks[0]), int(marks[-1])
        if ids[first] in ROLE_OF:
            role, start = ROLE_OF[int(ids[first])], first + 1
        else:
            role, start = self._text(ids[first + 1:marks[1]]), int(marks[1]) + 1
        self.turns.update(f"{role}\n{self._text(ids[start:last])}\n".encode())
        self.formatted_chars += sum(len(CONTROLS[int(i) - FIRST_RESERVED]) for i in ids[marks])
        learned = self._plain(ids[mask == 1])
        self.loss.update(learned.encode())
        self.loss_chars += len(learned)
        self.n_turns += 1
        self.n_tokens += len(ids)

    def _text(self, ids: np.ndarray) -> str:
        raw = self.decode(ids.tolist()).decode()
        self.formatted_chars += len(raw)
        return unescape(raw)

    def _plain(self, ids: np.ndarray) -> str:
        return unescape(self.decode(ids.tolist()).decode())

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars, self.n_tokens)


def read_back(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens)``, read from ids and masks alone.

    Rows of a conversation come sorted and are hashed one after the other, so a task holds one turn of it at a time.
    """
    path = tokenizer or public_tokenizers.path(RANKS)
    kind = dict(turns.dtypes)["conv_id"]
    schema = (f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
              "n_tokens long")
    columns = [c.split()[0] for c in schema.split(", ")]

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = _encoding(path).decode_bytes
        reader = None
        for frame in frames:
            done = []
            for key, ids, mask in zip(frame["conv_id"], frame["input_ids"], frame["loss_mask"], strict=True):
                key = None if pd.isna(key) else key
                if reader is None or reader.conv_id != key:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(key, decode)
                reader.take(np.asarray(ids), np.asarray(mask))
            if done:
                yield _typed(done)
        if reader is not None:
            yield _typed([reader.row()])

    def _typed(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=columns).astype({"conv_id": object})

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "input_ids", "loss_mask").mapInPandas(digest, schema)


def digests_sql(rows: str) -> str:
    """The same figures from the texts, without tokens: every escape adds one character."""
    special = "|".join([r"\\", *map(re.escape, CONTROLS)])
    lengths = " ".join(f"WHEN '{role}' THEN {len(a) + len(b)}" for role, (a, b) in MARKS.items())
    other = len("[ROLE]") + len("[/ROLE]") + len("</s>")
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM ({rows}))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
  CAST(sum(length(text) + len(regexp_extract_all(text, '{special}')) + CASE role {lengths} ELSE {other} + length(role)
       + len(regexp_extract_all(role, '{special}')) END) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""
