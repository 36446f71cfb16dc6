"""Chat formatting in budgeted windows, in native functions only.

A conversation's turns become training windows of at most ``budget`` tokens:

* *Template*: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  Inside texts every
  ``<`` + backslashes + ``|`` gets one backslash more, so a marker in a formatted string is
  always the template's own, and taking one backslash away gives the text back.
* *Windows*: prefix sums of turn tokens choose turn-aligned spans: a span ends before the turn
  whose prefix sum would leave the budget.  The system turn (the conversation's first turn, if
  its role is ``system``) is repeated in front of every later window, followed by limited
  history: the turns before the span, as far back as ``history_tokens`` and ``history_turns``
  turn numbers go.  A turn is never cut: one longer than the budget has a window of its own.
* *Mask*: ``loss_spans`` cover the assistant texts of the span only; a target that is repeated
  as history is masked, so every assistant text is trained on once.

Work is dealt by (conversation, block of ``block_turns`` turn numbers), so a conversation of
any length is spread over tasks; a span also ends where a block ends, and the next block gets
the history and system turn as copies.  A block that holds over ``crowded_rows`` rows (many rows
under the same turn numbers, or without one) is dealt by (turn, role, text) and its copies in
pieces; such a piece gets no context from other pieces.

Defined cases: null text or role is empty text; turns are in order of (turn, role, text), null
turns first, repeated rows are turns of their own; a null conversation id is one more
conversation; an empty table gives no window; other columns are ignored whatever their names;
a very long text is one turn, kept whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerguard.llm.common import store

START, END = "<|im_start|>", "<|im_end|>"
SYSTEM, TARGET = "system", "assistant"
#: tokens of the template around one turn
TURN_TOKENS = 5
#: token estimate: runs of letters by six, digits by three, signs by three, white space
TOKEN_PATTERN = r" ?\p{L}{1,6}| ?\p{N}{1,3}| ?[^\s\p{L}\p{N}]{1,3}|\s+"
BROADCAST_ROWS = 200_000

_COPY_OF_SYSTEM, _COPY_OF_TURN, _OWN = 0, 1, 2


def estimate_tokens(text: Column) -> Column:
    """Number of token-like pieces of a text."""
    return F.regexp_count(text, F.lit(TOKEN_PATTERN))


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape_text(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape_text(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _turns(conversations: DataFrame, key: str, block_turns: int) -> DataFrame:
    rows = conversations.select(F.col(key).alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                                F.monotonically_increasing_id().alias("row"))
    return rows.withColumn("block", F.floor(F.col("turn") / F.lit(block_turns)).cast("long"))


def _marked(rows: DataFrame, crowded_rows: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with what their block needs to know, and that table itself: the blocks of
    conversations with several blocks, and crowded blocks, from a count of narrow columns."""
    blocks = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    ends = blocks.groupBy("conv_id").agg(F.count("*").alias("parts"), F.max("block").alias("last"),
                                         F.max("n").alias("most"), F.min(F.struct("block")).alias("first"))
    special = ends.where((F.col("parts") > 1) | (F.col("most") > crowded_rows))
    marks = store(special.alias("s").join(blocks.alias("b"), F.expr("s.conv_id <=> b.conv_id"))
                  .select("b.conv_id", "b.block", "b.n", "s.parts", "s.last",
                          (F.struct("b.block") == F.col("s.first")).alias("is_first")), "chat-blocks")
    small = marks.count() <= BROADCAST_ROWS      # beyond that, a shuffle join
    side = F.broadcast(marks) if small else marks
    joined = rows.alias("r").join(side.alias("m"), F.expr("r.conv_id <=> m.conv_id and r.block <=> m.block"), "left")
    return joined.select("r.*", F.coalesce("m.n", F.lit(0)).alias("n"), F.coalesce("m.parts", F.lit(1)).alias("parts"),
                         "m.last", F.coalesce("m.is_first", F.lit(True)).alias("is_first")), marks


def _dealt(rows: DataFrame, marks: DataFrame, block_turns: int, history_turns: int, crowded_rows: int) -> DataFrame:
    """Turns and copied context with the block (and the piece of a crowded block) they go to."""
    crowded = F.col("n") > crowded_rows
    piece = F.when(crowded, F.struct("turn", "role", "text", F.pmod(
        "row", F.ceil(F.col("n") / crowded_rows)).alias("copy")))
    own = rows.withColumn("kind", F.lit(_OWN)).withColumn("piece", piece)
    none = F.lit(None).cast(own.schema["piece"].dataType)
    late = F.pmod(F.col("turn"), F.lit(block_turns)) >= block_turns - history_turns
    history = (rows.where(~crowded & late & (F.col("block") < F.col("last")))
               .withColumns({"block": F.col("block") + 1, "kind": F.lit(_COPY_OF_TURN), "piece": none,
                             "is_first": F.lit(False)}))
    first = (rows.where("parts > 1").groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text")).alias("f"))
             .where(F.col("f.role") == SYSTEM))
    system = (first.alias("f").join(marks.where(~F.col("is_first") & ~crowded).alias("m"),
                                    F.expr("f.conv_id <=> m.conv_id"))
              .select("f.conv_id", "f.f.turn", "f.f.role", "f.f.text", F.lit(0).cast("long").alias("row"), "m.block", "m.n", "m.parts",
                      "m.last", "m.is_first", F.lit(_COPY_OF_SYSTEM).alias("kind"), none.alias("piece")))
    return own.unionByName(history).unionByName(system)


def _spans(budget: int, history_tokens: int, history_turns: int) -> Column:
    """Spans (history from, start) over ``turns`` (copied turns first, the system turn
    taken out), chosen by ``prefix`` (tokens before each turn, and after the last)."""
    turns, prefix, copied = F.col("turns"), F.col("prefix"), F.col("copied")
    room = F.lit(budget) - F.col("system_tokens")

    def past(i: Column) -> Column:
        near = F.filter(F.sequence(F.lit(0), i), lambda j: (j == i) | (
            (F.get(prefix, i) - F.get(prefix, j) <= history_tokens)
            & (F.get(prefix, i + 1) - F.get(prefix, j) <= room)
            & (F.get(turns, j)["turn"] >= F.get(turns, i)["turn"] - history_turns)))
        return F.get(near, F.lit(0))

    def step(acc: Column, i: Column) -> Column:
        begins = F.get(prefix, i + 1) > acc["limit"]
        # a one-element array gives the start of the history a name, so it is looked for once
        begun = F.transform(F.array(past(i)), lambda came: F.struct(
            F.concat(acc["spans"], F.array(F.struct(came.alias("from"), i.alias("start")))).alias("spans"),
            (F.get(prefix, came) + room).alias("limit")))
        return F.when(begins, F.get(begun, F.lit(0))).otherwise(acc)

    empty = F.struct(F.array().cast("array<struct<from:int,start:int>>").alias("spans"),
                     F.lit(-1).cast("long").alias("limit"))
    own = F.when(F.size(turns) > copied, F.sequence(copied, F.size(turns) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(own, empty, step, lambda acc: acc["spans"])


def format_conversations(conversations: DataFrame, key: str = "conv_id", budget: int = 1024, history_tokens: int = 256,
                         history_turns: int = 4, block_turns: int = 256, crowded_rows: int = 4096,
                         count_tokens: Callable[[Column], Column] = estimate_tokens) -> DataFrame:
    """Windows of all conversations: conv_id, parts (blocks of the conversation), block, piece,
    window (number in its block, from 0), n_turns (of the span), n_repeated (turns in front of
    the span), n_tokens, n_chars, formatted, loss_spans (array of start, length in code points).

    ``conversations`` has ``key``, ``turn``, ``role`` and ``text``; see the module for the rules.
    """
    rows, marks = _marked(_turns(conversations, key, block_turns), crowded_rows)
    dealt = _dealt(rows, marks, block_turns, history_turns, crowded_rows)
    # parts follows from the conversation: as a key, a filter on it reaches the turns before they are dealt
    keys = ["conv_id", "block", "piece", "parts"]
    grouped = (dealt.repartition(*keys).groupBy(*keys)
               .agg(F.max("is_first").alias("is_first"),
                    F.sort_array(F.collect_list(F.struct("kind", "turn", "role", "text"))).alias("t"))
               .where(F.element_at("t", -1)["kind"] == _OWN))
    shown = F.transform("t", lambda t: F.struct(
        t["kind"].alias("kind"), t["turn"].alias("turn"), t["role"].alias("role"),
        escape_role(t["role"]).alias("shown_role"), escape_text(t["text"]).alias("shown"),
        (count_tokens(t["text"]) + TURN_TOKENS).cast("long").alias("tokens")))
    grouped = grouped.withColumn("t", shown)
    first = F.get("t", F.lit(0))
    own_system = F.col("is_first") & (first["role"] == SYSTEM) & F.col("piece").isNull()
    copy_of_system = first["kind"] == _COPY_OF_SYSTEM
    grouped = (grouped.withColumn("system", F.when(own_system | copy_of_system, first))
               .withColumn("turns", F.when(own_system | copy_of_system, F.slice("t", F.lit(2), F.size("t"))).otherwise(F.col("t")))
               .withColumn("own_system", own_system)
               .withColumn("system_tokens", F.coalesce(F.col("system.tokens"), F.lit(0)))
               .withColumn("copied", F.size(F.filter("turns", lambda t: t["kind"] != _OWN)))
               .withColumn("prefix", F.aggregate(
                   "turns", F.array(F.lit(0).cast("long")),
                   lambda acc, t: F.concat(acc, F.array(F.element_at(acc, -1) + t["tokens"])))))
    spans = grouped.withColumn("spans", _spans(budget, history_tokens, history_turns))
    # a block of nothing but the system turn still has one window
    spans = spans.withColumn("spans", F.when(F.size("spans") == 0, F.array(F.struct(
        F.lit(0).alias("from"), F.lit(0).alias("start")))).otherwise(F.col("spans")))
    # outer: no filter on the spans, which would be pushed below everything they are computed from
    w = spans.select("*", F.posexplode_outer("spans").alias("window", "span"))
    stop = F.coalesce(F.get("spans", F.col("window") + 1)["start"], F.size("turns"))
    w = w.withColumns({"stop": stop, "came": F.col("span.from"), "start": F.col("span.start")})
    new_system = F.col("own_system") & (F.col("window") == 0)
    w = w.withColumn("n_repeated", F.when(new_system, F.lit(0)).otherwise(
        F.col("start") - F.col("came") + F.when(F.col("system").isNull(), 0).otherwise(1)))
    w = w.withColumn("shown", F.transform(
        F.concat(F.when(F.col("system").isNull(), F.array().cast(w.schema["turns"].dataType)).otherwise(F.array("system")),
                 F.slice("turns", F.col("came") + 1, F.col("stop") - F.col("came"))),
        lambda t: F.struct(t["role"].alias("role"), F.concat(F.lit(START), t["shown_role"], F.lit("\n")).alias("head"),
                           t["shown"].alias("body"), t["tokens"].alias("tokens"))))
    tail = f"{END}\n"
    w = w.withColumn("ends", F.aggregate(
        "shown", F.array(F.lit(0)), lambda acc, t: F.concat(acc, F.array(
            F.element_at(acc, -1) + F.length(t["head"]) + F.length(t["body"]) + len(tail)))))
    number = F.sequence(F.lit(0), F.size("shown") - 1)
    targets = F.filter(number, lambda i: (i >= F.col("n_repeated")) & (F.get("shown", i)["role"] == TARGET))
    loss = F.transform(targets, lambda i: F.struct(
        (F.get("ends", i) + F.length(F.get("shown", i)["head"])).alias("start"),
        (F.get("ends", i + 1) - F.get("ends", i) - F.length(F.get("shown", i)["head"]) - len(tail)).alias("length")))
    return w.select(
        "conv_id", "parts", "block", "piece", "window",
        (F.size("shown") - F.col("n_repeated")).alias("n_turns"), "n_repeated",
        F.aggregate("shown", F.lit(0).cast("long"), lambda acc, t: acc + t["tokens"]).alias("n_tokens"),
        F.element_at("ends", -1).alias("n_chars"),
        F.array_join(F.transform("shown", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), "").alias("formatted"),
        loss.alias("loss_spans"))


def read_windows(windows: DataFrame) -> DataFrame:
    """The turns and targets of windows, read from their formatted strings: adds ``turns``
    (array of role, text; the window's span without repeated turns) and ``targets`` (array of
    the texts under the loss mask), both unescaped."""
    pieces = F.split("formatted", r"<\|im_start\|>", -1)
    own = F.slice(pieces, F.col("n_repeated") + 2, F.greatest(F.size(pieces), F.lit(1)))

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(1), F.length(piece) - (len(END) + 1))
        cut = F.locate("\n", body)
        return F.struct(unescape_role(F.substring(body, F.lit(1), cut - 1)).alias("role"),
                        unescape_text(F.substring(body, cut + 1, F.length(body))).alias("text"))

    return windows.withColumn("turns", F.transform(own, turn)).withColumn("targets", F.transform(
        "loss_spans", lambda s: unescape_text(F.substring("formatted", s["start"] + 1, s["length"]))))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, from its windows: n_turns, turns_sha256 (role, line feed, text, line feed
    of every turn), loss_chars and loss_sha256 (all text under the mask), formatted_chars, n_windows.

    Blocks are read first; only conversations of several blocks meet once more by their id.
    """
    w = read_windows(windows).withColumn("said", F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""))
    w = w.withColumn("learned", F.array_join("targets", ""))

    def gathered(df: DataFrame, *by: str) -> DataFrame:
        parts = F.sort_array(F.collect_list(F.struct("place", "said", "learned")))
        return df.groupBy(*by).agg(
            parts.alias("p"), F.sum("n_turns").cast("long").alias("n_turns"),
            F.sum("formatted_chars").alias("formatted_chars"), F.sum("n_windows").alias("n_windows")).withColumns({
                "said": F.array_join(F.transform("p", lambda p: p["said"]), ""),
                "learned": F.array_join(F.transform("p", lambda p: p["learned"]), "")}).drop("p")

    w = w.select("conv_id", "parts", "block", "piece", F.col("window").alias("place"), "said", "learned", "n_turns",
                 F.length("formatted").cast("long").alias("formatted_chars"), F.lit(1).cast("long").alias("n_windows"))
    blocks = gathered(w, "conv_id", "block", "piece", "parts")
    whole = F.col("piece").isNull() & (F.col("parts") == 1)
    columns = ["conv_id", "n_turns", "said", "learned", "formatted_chars", "n_windows"]
    several = gathered(blocks.where(~whole).withColumn("place", F.struct("block", "piece")), "conv_id")
    each = blocks.where(whole).select(*columns).unionByName(several.select(*columns))
    return each.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       "formatted_chars", "n_windows")
