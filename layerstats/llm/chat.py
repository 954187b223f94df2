"""Conversations as training text in windows of a token budget.

Prefix sums of the turns' tokens decide where windows begin, always between
turns: for each turn the one with which the next window would begin is looked up in
the sums, and which turns do begin one is found along these links by pointer doubling. Every window repeats the system turn and a limited end of the window
before it; only the assistant texts that a window adds are under its loss mask,
so each is learned once. Built from DataFrame functions alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerstats.llm.store import written

OPEN, AFTER_ROLE, CLOSE = "### ", ": ", " </turn>\n"
#: Control strings and what stands for them inside texts; the backslash comes first.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
TOKEN = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
#: Turn numbers that are added up together before the sums of such runs are.
RUN = 64
#: Tokens of a stretch of a conversation in which turns are looked up by their sums.
CELL = 256


def escape(text: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, mark in pairs:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescape(text: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, mark in reversed(pairs):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def count_tokens(text: Column) -> Column:
    """Words and other signs, each one token."""
    return F.regexp_count(text, F.lit(TOKEN))


def _begins(turns: DataFrame) -> DataFrame:
    """conv, pos and next: the turns that begin a window, and where the next window begins or the conversation is over."""
    same = F.col("conv").eqNullSafe(F.col("o_conv"))
    end = F.col("start") + F.col("tokens")
    # The next window begins with the turn that holds the first token for which there is no more room.
    first_out = turns.withColumn("at", F.col("start") + F.col("room"))
    there = turns.select(
        F.col("conv").alias("o_conv"), F.col("pos").alias("o_pos"), F.col("start").alias("o_start"), end.alias("o_end"),
        F.explode(F.sequence(F.floor(F.col("start") / CELL), F.floor((end - 1) / CELL))).alias("cell"),
    )
    inside = same & (F.floor(F.col("at") / CELL) == F.col("cell")) & (F.col("o_start") <= F.col("at")) & (F.col("at") < F.col("o_end"))
    found = first_out.join(there, inside, "left").select("conv", "pos", "n_conv", F.when(F.col("o_pos").isNotNull(), F.greatest("o_pos", F.col("pos") + 1)).alias("next"))
    # A turn too long for any window is followed by the next one, if there is one.
    over = F.when(F.col("next") <= F.col("n_conv"), F.col("next"))
    linked = written(found.select("conv", "pos", over.alias("next"), (F.col("n_conv") + 1).alias("past")), "links")
    jumps = [linked.where("next is not null").select("conv", "pos", "next")]
    while True:
        on = jumps[-1].select(F.col("conv").alias("o_conv"), F.col("pos").alias("o_pos"), F.col("next").alias("o_next"))
        twice = jumps[-1].join(on, same & (F.col("next") == F.col("o_pos"))).select("conv", "pos", F.col("o_next").alias("next"))
        twice = written(twice, "jumps")
        if twice.isEmpty():
            break
        jumps.append(twice)
    reached = written(turns.groupBy("conv").agg(F.min("pos").alias("pos")), "begins")
    for jump in reversed(jumps):
        on = jump.select(F.col("conv").alias("o_conv"), F.col("pos").alias("o_pos"), "next")
        further = reached.join(on, same & (F.col("pos") == F.col("o_pos"))).select("conv", F.col("next").alias("pos"))
        reached = written(reached.unionByName(further), "begins")
    on = linked.select(F.col("conv").alias("o_conv"), F.col("pos").alias("o_pos"), F.coalesce("next", "past").alias("next"))
    return reached.join(on, same & (F.col("pos") == F.col("o_pos"))).select("conv", "pos", "next")


def windows(
    turns: DataFrame,
    budget: int = 1024,
    history: int = 128,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokens: Callable[[Column], Column] = count_tokens,
) -> DataFrame:
    """One row for each window: conv_id, window, formatted, loss_spans, n_tokens, n_turns, n_repeated, over_budget.

    ``loss_spans`` lists start and length, in characters of ``formatted``, of the
    escaped assistant texts that the window adds. ``n_repeated`` is the number of
    turns at its start that other windows hold too; ``n_turns`` counts those it adds.
    ``window`` orders the windows of a conversation.

    Turns are in order of ``turn`` (null first), then role and text; repeated rows
    are turns of their own. Null roles and texts are empty; rows of a null
    conversation belong together. A first turn with the role ``system`` is
    repeated in every window. ``history`` bounds the tokens of earlier turns that are
    repeated, which come from the window just before. Each window takes as many turns as
    fit into what system turn and history leave. It is over budget only if it adds a single
    turn that is longer; no text is ever cut. Texts may be of any length. Empty tables give
    no windows; other columns are not looked at, whatever their names.

    No step needs a whole conversation in one task: turns are summed within runs
    of ``RUN`` turn numbers, then the runs are; turns are looked up within ``CELL`` tokens;
    and links are followed in as many rounds as the longest chain of windows has binary digits.
    Turns, links and windows are written
    tables in the shared folder, so the call itself runs Spark jobs.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be at least 0 and less than budget")
    escaped = escape(F.coalesce(F.col(text).cast("string"), F.lit("")))
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit(AFTER_ROLE))
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.floor(F.col(turn) / RUN).alias("run"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        escaped.alias("escaped"),
    )
    rows = rows.withColumns({"head": F.length(head), "body": F.concat(head, "escaped", F.lit(CLOSE))})
    rows = rows.withColumns({"chars": F.length("body").cast("long"), "tokens": tokens(F.col("body")).cast("long") + 1})

    in_run = Window.partitionBy("conv", "run").orderBy("turn", "role", "escaped")
    so_far = in_run.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns(
        {"place": F.row_number().over(in_run), "token_end": F.sum("tokens").over(so_far), "char_end": F.sum("chars").over(so_far)}
    )
    rows = written(rows, "turns")  # read three times below
    runs = rows.groupBy("conv", "run").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"), F.sum("chars").alias("c"))
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv")
    runs = runs.select(
        F.col("conv").alias("r_conv"),
        F.col("run").alias("r_run"),
        *(F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"{x}_before") for x in ("n", "t", "c")),
        F.sum("n").over(whole).alias("n_conv"),
    )
    rows = rows.join(runs, F.col("conv").eqNullSafe(F.col("r_conv")) & F.col("run").eqNullSafe(F.col("r_run")))
    first_system = (F.col("n_before") + F.col("place") == 1) & (F.col("role") == "system")
    rows = rows.select(
        "conv", "role", "escaped", "head", "body", "chars", "tokens", "n_conv",
        (F.col("n_before") + F.col("place")).alias("pos"),
        (F.col("t_before") + F.col("token_end") - F.col("tokens")).alias("start"),
        (F.col("c_before") + F.col("char_end") - F.col("chars")).alias("char_start"),
        first_system.alias("system"),
    )
    system = rows.where("system").select(
        F.col("conv").alias("s_conv"), F.col("body").alias("s_body"), F.col("tokens").alias("s_tokens"), F.col("chars").alias("s_chars")
    )
    rows = rows.join(system, F.col("conv").eqNullSafe(F.col("s_conv")), "left")
    rows = rows.withColumns({"s_body": F.coalesce("s_body", F.lit("")), "s_tokens": F.coalesce("s_tokens", F.lit(0)), "s_chars": F.coalesce("s_chars", F.lit(0))})

    # A system turn alone in its conversation still has a window.
    rows = rows.where(~F.col("system") | (F.col("n_conv") == 1))
    room = F.greatest(F.lit(1), F.lit(budget - history) - F.col("s_tokens"))
    begins = _begins(rows.select("conv", "pos", "start", "tokens", "n_conv", room.alias("room")))
    member = begins.select(F.col("conv").alias("w_conv"), F.col("pos").alias("window"), F.explode(F.sequence("pos", F.col("next") - 1)).alias("w_pos"))
    rows = rows.join(member, F.col("conv").eqNullSafe(F.col("w_conv")) & (F.col("pos") == F.col("w_pos")))
    item = F.struct("start", "char_start", "tokens", "chars", "head", "role", F.when(F.col("system"), "").otherwise(F.col("body")).alias("body"), F.length("escaped").alias("size"))
    spans = rows.groupBy("conv", "window").agg(
        F.array_sort(F.collect_list(item)).alias("turns"),
        F.min("start").alias("start"),
        F.max(F.col("start") + F.col("tokens")).alias("end"),
        F.first("s_body").alias("s_body"),
        F.first("s_tokens").alias("s_tokens"),
        F.first("s_chars").alias("s_chars"),
        F.max("n_conv").alias("n_conv"),
        F.bool_or("system").alias("only_system"),
    )
    spans = written(spans, "spans").withColumn("tail", F.filter("turns", lambda t: (F.col("end") - t["start"] <= history)))
    before = spans.where(F.size("tail") > 0).select(
        F.col("conv").alias("b_conv"), F.col("end").alias("b_end"),
        F.array_join(F.transform("tail", lambda t: t["body"]), "").alias("b_body"),
        F.aggregate("tail", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("b_tokens"),
        F.size("tail").alias("b_turns"),
    ).where("b_body != ''")
    # Turns follow each other without gaps, so a window begins where the one before ends.
    out = spans.join(before, F.col("conv").eqNullSafe(F.col("b_conv")) & (F.col("start") == F.col("b_end")), "left")
    prefix = F.concat("s_body", F.coalesce("b_body", F.lit("")))
    first = F.col("start") == F.col("s_tokens")
    n_tokens = F.col("end") - F.col("start") + F.when(F.col("only_system"), 0).otherwise(F.col("s_tokens")) + F.coalesce("b_tokens", F.lit(0))
    return out.select(
        F.col("conv").alias("conv_id"),
        "window",
        F.concat(prefix, F.array_join(F.transform("turns", lambda t: t["body"]), "")).alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["role"] == "assistant"),
            lambda t: F.struct(
                (t["char_start"] - F.col("turns")[0]["char_start"] + F.length(prefix) + t["head"]).cast("int").alias("start"),
                t["size"].alias("length"),
            ),
        ).alias("loss_spans"),
        n_tokens.alias("n_tokens"),
        (F.size("turns") + F.when(first & (F.col("s_tokens") > 0), 1).otherwise(0)).alias("n_turns"),
        (F.when(~first & (F.col("s_tokens") > 0) & ~F.col("only_system"), 1).otherwise(0) + F.coalesce("b_turns", F.lit(0))).alias("n_repeated"),
        (n_tokens > budget).alias("over_budget"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """What windows say, from their text and mask alone: conv_id, window, turns (role, text) and learned (texts).

    ``turns`` are those that a window adds, ``learned`` the texts under its mask, all unescaped.
    """
    parts = F.split("formatted", CLOSE, -1)
    colon = lambda p: F.instr(p, ":")
    own = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))
    return formatted.select(
        "conv_id",
        "window",
        F.transform(
            own,
            lambda p: F.struct(
                unescape(F.substr(p, F.lit(len(OPEN) + 1), colon(p) - len(OPEN) - 1), ROLE_ESCAPES).alias("role"),
                unescape(F.substr(p, colon(p) + len(AFTER_ROLE))).alias("text"),
            ),
        ).alias("turns"),
        F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))).alias("learned"),
        F.length("formatted").alias("formatted_chars"),
    )
