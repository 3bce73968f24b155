"""Chat formatting: conversations merged into prefix trees of token segments."""

from __future__ import annotations

import base64
import hashlib
import importlib.util
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsmart.llm.places import placed
from subsmart.llm.tables import bound_batches, read, stored
from subsmart.llm.token_counts import TOKENIZERS
from subsmart.operators.spread import sized

VOCABULARY = "byte_bpe_50k.tiktoken"
# A turn is formatted as OPEN role SEPARATOR text CLOSE.
OPEN, SEPARATOR, CLOSE = "### ", ": ", "</turn>\n"
LEARNED_ROLE = "assistant"

_IN_TEXT = re.compile(r"\\|(?<=#)#|(?<=<)/turn>")
_IN_ROLE = re.compile(r"\\|(?<=#)#|(?<=<)/turn>|(?<=:) ")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str, pattern: re.Pattern = _IN_TEXT) -> str:
    """``text`` in which no control string stands: a backslash goes before every backslash,
    before a ``#`` after a ``#``, and behind the ``<`` of a closing mark."""
    return pattern.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parsed(turn: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    if not (turn.startswith(OPEN) and turn.endswith(CLOSE)):
        raise ValueError("not a formatted turn")
    role, text = turn[len(OPEN) : -len(CLOSE)].split(SEPARATOR, 1)
    return unescaped(role), unescaped(text)


_LOADED: dict[tuple[str, str], object] = {}


def encoding(folder: str = TOKENIZERS, name: str = VOCABULARY):
    """The public byte-level vocabulary, loaded once by each Python worker."""
    if (folder, name) not in _LOADED:
        import tiktoken

        spec = importlib.util.spec_from_file_location("public_tokenizers", f"{folder}/__init__.py")
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        with open(module.path(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _LOADED[folder, name] = tiktoken.Encoding(
            name, pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _LOADED[folder, name]


TURNS = (
    "conv_id long, depth long, node_high long, node_low long, tokens array<int>, n_tokens long, "
    "loss_from long, loss_to long, position long"
)


def _names(kinds: str) -> list[str]:
    return [x.split()[0] for x in kinds.split(", ")]


def _batch(rows: list[tuple], kinds: str) -> pa.RecordBatch:
    to_arrow = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    types = [to_arrow[x.split()[1]] for x in kinds.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _names(kinds))


def _tokenised(folder: str):
    """Formats turns that come sorted by conversation and turn.

    What is kept between turns is the hash of the turns so far, and their number of tokens.
    """

    def run(batches):
        encode = encoding(folder).encode_ordinary
        last, depth, position, prefix = (), 0, 0, b""
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (conv,) != last:
                    last, depth, position, prefix = (conv,), 0, 0, b""
                role, text = role or "", text or ""
                own = role.encode()
                turn = hashlib.blake2b(prefix + len(own).to_bytes(8) + own, digest_size=16)
                turn.update(text.encode())
                prefix = turn.digest()
                head = encode(OPEN + escaped(role, _IN_ROLE) + SEPARATOR)
                body = encode(escaped(text))
                tokens = [*head, *body, *encode(CLOSE)]
                end = len(head) + (len(body) if role == LEARNED_ROLE else 0)
                high, low = (int.from_bytes(x, signed=True) for x in (prefix[:8], prefix[8:]))
                rows.append((conv, depth, high, low, tokens, len(tokens), len(head), end, position))
                depth, position = depth + 1, position + len(tokens)
            yield _batch(rows, TURNS)

    return run


@dataclass(frozen=True)
class Packed:
    """Prefix trees as token segments, and where each conversation lies in them.

    ``segments``, stored in order of ``tree`` and ``start``: one row per distinct beginning
    of conversations, for its last turn. ``tree`` and ``chain`` are the least ``conv_id`` of
    the conversations that share the first turn and this turn; ``depth`` counts turns from
    0; ``start`` is the offset of the first token in the tree, ``position`` its position id
    (later tokens count on); ``tokens`` are ids, of which those from ``loss_from`` to
    ``loss_to`` are learned; ``attend`` has the intervals of the tree that hold the
    ancestors in other chains. A token attends to them and to its own chain before it.

    ``reads``: for each ``conv_id`` the intervals that make it up, one row each: ``chain``,
    ``tree``, ``start``, ``end``.
    """

    segments: DataFrame
    reads: DataFrame


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def pack(conversations: DataFrame, folder: str = TOKENIZERS) -> Packed:
    """Merge conversations that begin with the same turns, and lay the trees out depth-first.

    ``conversations`` has ``conv_id``, ``turn``, ``role``, ``text``. Turns are sorted by
    ``turn`` (nulls first), then role and text; rows that repeat are turns of their own. A
    null text or role is empty; rows without ``conv_id`` are one conversation. Other columns
    are not read; a table without rows gives no segments.

    A beginning is known by a chained 128-bit hash, made while a conversation's turns pass
    through a task in order, so a long one is never held whole. Of the conversations with a
    common beginning the least owns it; along a conversation owners only rise, so each owns
    one unbroken chain, and the points where the owner changes name its place in the
    depth-first order. Offsets come from a sort into ranges, so a tree, such as that of a
    very common first turn, may have any size.
    """
    bound_batches(conversations.sparkSession)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    turns = stored(
        conversations.select(F.col("conv_id").cast("long"), "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "role", "text")
        .mapInArrow(_tokenised(folder), TURNS)
    )
    node = ["node_high", "node_low"]
    owners = turns.groupBy(*node).agg(F.min("conv_id").alias("chain"))
    # One row per conversation and owner of a part of it.
    parts = stored(
        turns.select("conv_id", "depth", "position", "n_tokens", *node)
        .join(owners, node)
        .groupBy("conv_id", "chain")
        .agg(
            F.min("depth").alias("from_depth"),
            F.min("position").alias("from_position"),
            F.sum("n_tokens").alias("size"),
        )
    )
    # Deeper branches first: after the last turn of a chain the nearest branch follows.
    path = F.sort_array(F.collect_list(F.struct("from_depth", "chain")))
    paths = parts.groupBy(F.col("conv_id").alias("_conv")).agg(path.alias("_path")).select(
        "_conv",
        F.col("_path")[0]["chain"].alias("tree"),
        F.transform("_path", lambda x: F.struct((-x["from_depth"]).alias("a"), x["chain"].alias("b"))).alias("_path"),
    )
    own = parts.filter(_same("conv_id", "chain")).join(paths, _same("conv_id", "_conv"))
    keyed = own.select(
        F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("")).alias("_tree"),
        "tree", "chain", "from_depth", "from_position", "size", "_path",
    )
    laid = placed(keyed, [F.col("_tree").asc(), F.col("_path").asc()], "_tree", F.col("size"))
    chains = stored(laid.select("tree", "chain", "from_depth", "from_position", F.col("pos").alias("first")))
    starts = sized(chains.select(F.col("chain").alias("_chain"), "tree", "first")).frame
    reads = stored(
        parts.join(starts, _same("chain", "_chain")).select(
            "conv_id",
            "chain",
            "tree",
            F.col("first").alias("start"),
            (F.col("first") + F.col("size")).alias("end"),
        )
    )
    attend = F.sort_array(F.collect_list(F.struct("start", "end")))
    above = (
        reads.filter(~_same("conv_id", "chain"))
        .groupBy(F.col("conv_id").alias("_conv"))
        .agg(attend.alias("attend"))
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    known = sized(
        chains.join(above, _same("chain", "_conv"), "left").select(
            "tree", "chain", "from_depth", "from_position", "first", F.coalesce("attend", none).alias("attend")
        )
    ).frame
    segments = turns.join(known, _same("conv_id", "chain")).filter("depth >= from_depth").select(
        "tree",
        "chain",
        "depth",
        (F.col("first") + F.col("position") - F.col("from_position")).alias("start"),
        "position",
        "tokens",
        "loss_from",
        "loss_to",
        "attend",
    )
    depth_first = [F.col("tree").asc(), F.col("start").asc()]
    return Packed(stored(segments.repartitionByRange(*depth_first).sortWithinPartitions(*depth_first)), reads)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


class _Digest:
    def __init__(self):
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, turn: str, learned: str) -> None:
        role, text = parsed(turn)
        self.turns.update(f"{role}\n{text}\n".encode())
        learned = unescaped(learned)
        self.loss.update(learned.encode())
        self.n_turns += 1
        self.loss_chars += len(learned)
        self.formatted_chars += len(turn)

    def row(self, conv) -> tuple:
        return (
            conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars
        )


def _digested(folder: str):
    """Reads turns back from token ids that come sorted by conversation and position."""

    def run(batches):
        decode, last, digest = encoding(folder).decode_bytes, (), None
        for batch in batches:
            rows = []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for conv, tokens, begin, end in zip(*columns):
                if (conv,) != last:
                    if digest:
                        rows.append(digest.row(*last))
                    last, digest = (conv,), _Digest()
                digest.add(decode(tokens).decode(), decode(tokens[begin:end]).decode())
            yield _batch(rows, DIGESTS)
        if digest:
            yield _batch([digest.row(*last)], DIGESTS)

    return run


def conversation_segments(packed: Packed) -> DataFrame:
    """The segments of each conversation: ``conv_id`` and the columns of ``segments``."""
    reads = packed.reads.select("conv_id", F.col("chain").alias("_chain"), F.col("start").alias("_from"), "end")
    inside = (F.col("start") >= F.col("_from")) & (F.col("start") < F.col("end"))
    return packed.segments.join(reads, _same("chain", "_chain") & inside).select(
        "conv_id", *packed.segments.columns
    )


def digests(packed: Packed, folder: str = TOKENIZERS) -> DataFrame:
    """Turns, learned text and length of every conversation, read back from the token ids."""
    bound_batches(packed.segments.sparkSession)
    found = conversation_segments(packed)
    return (
        found.select("conv_id", "position", "tokens", "loss_from", "loss_to")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "position")
        .select("conv_id", "tokens", "loss_from", "loss_to")
        .mapInArrow(_digested(folder), DIGESTS)
    )


# The conversation that the query adds: its id, and the text of its two turns.
PLANTED, PLANTED_TEXT = -7, r"\### Assistant: </turn> ok"


def with_planted(conversations: DataFrame) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    rows = [(PLANTED, turn, role, PLANTED_TEXT) for turn, role in enumerate(["user", LEARNED_ROLE])]
    planted = conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select(*columns).unionByName(planted)


def op13_chat(spark, sf_dir) -> DataFrame:
    """What is read back of every conversation from the packed prefix trees."""
    return digests(pack(with_planted(read(spark, sf_dir, "conversations"))))


ORACLE = r"""
with turns as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all
  select -7, turn, role, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) planted(turn, role)
), sized as (
  select *, 14 + length(role) + length(text)
    + length(role || text) - length(replace(role || text, '\', ''))
    + len(regexp_extract_all(role, '#')) - len(regexp_extract_all(role, '#+'))
    + len(regexp_extract_all(text, '#')) - len(regexp_extract_all(text, '#+'))
    + len(regexp_extract_all(role, ': ')) + len(regexp_extract_all(role, '</turn>')) + len(regexp_extract_all(text, '</turn>')) as formatted
  from turns
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(formatted)::bigint as formatted_chars
from sized group by conv_id
"""
