"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns
of one role are merged by array functions, as slices between the places where the
role changes; the template is concatenated.

    <|start|>ROLE<|text|>TEXT<|more|>TEXT<|end|>

one block to a run of turns of one role, blocks joined by a newline. Inside
roles and texts a backslash becomes ``\\s``, ``<`` becomes ``\\l`` and ``[``
becomes ``\\b``, so that no control string of this or the usual templates can
appear there; replacing in the opposite order restores them. ``loss_spans``
holds the offset and length, in code points of ``formatted``, of each assistant
text.

Null roles and texts count as empty. Equal turn numbers are ordered by role and
text, null numbers come first; repeated rows are kept. A null conv_id is a
conversation of its own. A conversation is one row in the end, so a very long one is
one task's work; no step copies what it has so far at every turn: slices, prefix
sums by doubling and substrings of four bytes a code point take n log n in turns and
time linear in the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, TEXT, MORE, END = "<|start|>", "<|text|>", "<|more|>", "<|end|>"
LEARNED_ROLE = "assistant"


def escape(x: str) -> str:
    return rf"replace(replace(replace({x}, '\\', '\\s'), '<', '\\l'), '[', '\\b')"


def unescape(x: str) -> str:
    return rf"replace(replace(replace({x}, '\\b', '['), '\\l', '<'), '\\s', '\\')"


def format_chats(rows: DataFrame, learned: str = LEARNED_ROLE) -> DataFrame:
    """(conv_id, formatted, loss_spans) from rows (conv_id, turn, role, text)."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    starts = turns.selectExpr("conv_id", "turns", "filter(sequence(0, size(turns) - 1), i -> i = 0 or get(turns, i).role <> get(turns, i - 1).role) as starts")
    own = "slice(turns, s + 1, coalesce(get(starts, j + 1), size(turns)) - s)"
    merged = starts.selectExpr("conv_id", f"transform(starts, (s, j) -> named_struct('role', get(turns, s).role, 'texts', transform({own}, x -> {escape('x.text')}))) as blocks")
    formatted = f"array_join(transform(blocks, b -> concat('{START}', {escape('b.role')}, '{TEXT}', array_join(b.texts, '{MORE}'), '{END}')), '\n')"
    # what stands before and after each text in the template
    head = f"length({escape('b.role')}) + {len(START) + len(TEXT)}"
    pieces = f"""flatten(transform(blocks, b -> transform(b.texts, (t, i) -> named_struct('learned', b.role = '{learned}', 'n', length(t),
        'before', if(i = 0, {head}, {len(MORE)}), 'after', if(i = size(b.texts) - 1, {len(END) + 1}, 0)))))"""
    ends = """aggregate(filter(sequence(0, 30), k -> shiftleft(1L, k) < size(pieces)), transform(pieces, p -> p.before + p.n + p.after),
        (a, k) -> transform(a, (x, i) -> x + coalesce(get(a, i - shiftleft(1, k)), 0)))"""
    spans = f"zip_with(pieces, {ends}, (p, e) -> named_struct('learned', p.learned, 'at', e - p.after - p.n, 'n', p.n))"
    placed = merged.selectExpr("conv_id", f"{formatted} as formatted", f"{pieces} as pieces")
    return placed.selectExpr("conv_id", "formatted", f"transform(filter({spans}, s -> s.learned), s -> named_struct('at', s.at, 'n', s.n)) as loss_spans")


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_text) as the formatted text and its spans alone give them."""
    blocks = r"filter(split(formatted, '<\\|start\\|>', -1), (b, i) -> i > 0)"
    body = r"substring_index(substring_index(b, '<|end|>', 1), '<|text|>', -1)"
    turns = rf"""flatten(transform({blocks}, b -> transform(split({body}, '<\\|more\\|>', -1), t -> named_struct(
        'role', {unescape("substring_index(b, '<|text|>', 1)")}, 'text', {unescape("t")}))))"""
    # at four bytes a code point a span is cut out without walking through what precedes it; w is made once
    own = unescape("decode(substring(w, 4 * s.at + 1, 4 * s.n), 'UTF-32')")
    loss = f"get(transform(array(encode(formatted, 'UTF-32')), w -> array_join(transform(loss_spans, s -> {own}), '')), 0)"
    return chats.selectExpr("conv_id", "formatted", f"{turns} as turns", f"{loss} as loss_text")
