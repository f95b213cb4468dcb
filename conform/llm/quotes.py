"""Chat formatting: quoted passages linked to their originals, conversations in reply order without quotes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conform.llm.common import read, stored

_MARK = re.compile(r"^(?:[ \t]*>)+ ?")
_BLANKS = re.compile(r"\s+")


def normalised(passage: str) -> str:
    return _BLANKS.sub(" ", passage).strip().lower()


def passages(text: str) -> list[tuple[int, str]]:
    """Runs of lines of one quote level, top to bottom: (level, text without its marks); level 0 is own text."""
    out: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        mark = _MARK.match(line)
        level, rest = (mark.group().count(">"), line[mark.end() :]) if mark else (0, line)
        if out and out[-1][0] == level:
            out[-1][1].append(rest)
        else:
            out.append((level, [rest]))
    return [(level, "\n".join(lines)) for level, lines in out]


def _hash(passage: str) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(passage.encode("utf-8", "surrogatepass"))


def link_quotes(
    messages: DataFrame, id_col: str, text_col: str = "text", scope: tuple[str, ...] = (), order_col: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Each message without its quotes, and the message that it answers.

    A quoted passage is a run of lines of one level (number of ``>`` marks). Its normalised text (white
    space collapsed, lower case) is hashed and joined to the hashes of what messages say themselves: the
    whole own text, and each run of own text between quotes. If a passage has no original, its lines are looked up
    one by one, as a part of a message may be quoted. Originals must lie in the same ``scope`` columns (a mailbox,
    a thread) and before the message by ``order_col`` (default: the id); of several originals of one
    passage the latest before the message counts (at one time, the largest id), as a reply quotes what was said last. A message answers the original of its lowest quote level, the latest if there are several.

    Returns the scope columns, the id, the ``keep`` columns as they are, ``clean`` (own text, outer blank lines off), ``n_quotes`` (quoted passages),
    ``n_linked`` (those with an original) and ``reply_to`` (id or null). A null text is an empty one; passages without
    words are not linked. Rows with a null id are kept and link to nothing, and nothing links to them. Each row that
    repeats an id is answered by its own text. Empty input gives no rows. Columns that clash in name are not used.
    """
    clash = {c.lower() for c in keep} & {c.lower() for c in (*scope, id_col, "clean", "n_quotes", "n_linked", "reply_to")}
    if clash:
        raise ValueError(f"columns to keep that the result has itself: {sorted(clash)}")
    order = F.col(order_col or id_col)
    keyed = messages.select(
        *[F.col(c).alias(f"s{i}") for i, c in enumerate(scope)],
        F.col(id_col).alias("id"),
        order.alias("at"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
    ).withColumn("row", F.monotonically_increasing_id())
    scopes = [f"s{i}" for i in range(len(scope))]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, quotes, own, own_lines = [], [], [], []
            for text in batch.column("text").to_pylist():
                parts = passages(text)
                said = [p for level, p in parts if level == 0]
                whole = "\n".join(said)
                clean.append(whole.strip("\n"))
                keys = {normalised(x) for x in (whole, *said)} - {""}
                own.append([_hash(k) for k in keys])
                own_lines.append([_hash(k) for k in {normalised(x) for x in whole.split("\n")} - {""}])
                found = []
                for n, (level, p) in enumerate(parts):
                    if level and normalised(p):
                        lines = [normalised(x) for x in p.split("\n")]
                        found.append({"n": n, "level": level, "key": _hash(normalised(p)), "lines": [_hash(x) for x in lines if x]})
                quotes.append(found)
            kind = pa.list_(pa.struct([("n", pa.int32()), ("level", pa.int32()), ("key", pa.binary()), ("lines", pa.list_(pa.binary()))]))
            arrays = [
                pa.array(clean, pa.string()), pa.array(quotes, kind),
                pa.array(own, pa.list_(pa.binary())), pa.array(own_lines, pa.list_(pa.binary())),
            ]
            rest = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], *arrays], [*rest, "clean", "quotes", "own", "own_lines"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema if f.name != "text")
    parsed = stored(
        keyed.mapInArrow(
            parse, head + ", clean string, quotes array<struct<n:int,level:int,key:binary,lines:array<binary>>>, "
            "own array<binary>, own_lines array<binary>",
        ),
        "quotes-parsed",
    )
    quoted = parsed.where("id is not null").select("row", *scopes, "at", F.explode("quotes").alias("q"))
    quoted = quoted.select("row", *scopes, "at", "q.*")

    def matched(asked: DataFrame, column: str) -> DataFrame:
        """``asked`` with the latest original before it, ``o``.

        Originals and quotes are ranged by key and time, so that a key with many of both is shared by many tasks. Within a range
        a window finds the original; a key that spans ranges takes what the ranges before hold, one row a range.
        """
        known = parsed.where("id is not null and at is not null").select(*scopes, "id", "at", F.explode(column).alias("key"))
        known = known.groupBy(*scopes, "key", "at").agg(F.max("id").alias("id")).select(*scopes, "key", "at", F.struct("at", "id").alias("o"))
        events = asked.withColumn("o", F.lit(None).cast(known.schema["o"].dataType)).unionByName(known, allowMissingColumns=True)
        events = stored(events.repartitionByRange(*scopes, "key", "at").withColumn("part", F.spark_partition_id()), "quotes-events")
        # At one time quotes come first: an original is earlier than what quotes it.
        before = Window.partitionBy("part", *scopes, "key").orderBy("at", F.col("row").isNull()).rowsBetween(Window.unboundedPreceding, 0)
        near = events.withColumn("o", F.last("o", ignorenulls=True).over(before)).where("row is not null")
        earlier = Window.partitionBy(*scopes, "key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        far = events.groupBy(*scopes, "key", "part").agg(F.max("o").alias("o")).withColumn("o", F.max("o").over(earlier)).where("o is not null")
        on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("part", "key", *scopes)]
        return near.alias("a").join(far.alias("b"), on, "left").select(
            *[f"a.{c}" for c in asked.columns], F.coalesce("a.o", "b.o").alias("o")
        )

    by_passage = stored(matched(quoted, "own"), "quotes-linked")
    by_line = matched(
        by_passage.where("o is null").select("row", *scopes, "at", "n", "level", F.explode("lines").alias("key")), "own_lines"
    )
    links = by_passage.select("row", "n", "level", "o").unionByName(by_line.select("row", "n", "level", "o"))
    per_row = (
        links.groupBy("row", "n", "level").agg(F.max("o").alias("o"))
        .groupBy("row")
        .agg(
            F.count("*").alias("n_quotes"),
            F.count("o").alias("n_linked"),
            F.max(F.when(F.col("o").isNotNull(), F.struct((-F.col("level")).alias("near"), F.col("o.at").alias("at"), F.col("o.id").alias("id")))).alias("parent"),
        )
    )
    return parsed.join(per_row, "row", "left").select(
        *[F.col(s).alias(c) for s, c in zip(scopes, scope, strict=True)],
        F.col("id").alias(id_col),
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        "clean",
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.col("parent.id").alias("reply_to"),
    )


def _same(scopes: list[str], left: str, right: str) -> list:
    """Join condition: ``a``'s column ``left`` names ``b``'s column ``right``, in one scope."""
    return [F.col(f"a.{left}") == F.col(f"b.{right}"), *[F.col(f"a.{s}").eqNullSafe(F.col(f"b.{s}")) for s in scopes]]


def _followed(nodes: DataFrame, scopes: list[str]) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (scope, id, up) with the end of their pointers as ``up`` and the ``steps`` to it, and those whose pointers have no end.

    Pointers are doubled; after as many steps as there are nodes, what still moves goes round a cycle.
    """
    state = nodes.withColumn("steps", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long"))
    ended, moving = state.where("up is null"), state.where("up is not null")
    reach, most = 1, nodes.count()
    while reach <= 2 * most and not moving.isEmpty():
        hopped = stored(
            moving.alias("a").join(moving.unionByName(ended).alias("b"), _same(scopes, "up", "id"), "left").select(
                *[f"a.{s}" for s in scopes], "a.id",
                F.coalesce("b.up", "a.up").alias("up"),
                (F.col("a.steps") + F.when(F.col("b.up").isNotNull(), F.col("b.steps")).otherwise(0)).alias("steps"),
                F.col("b.up").isNotNull().alias("moved"),
            ),
            "quotes-pointers",
        )
        ended = ended.unionByName(hopped.where("not moved").drop("moved"))
        moving = hopped.where("moved").drop("moved")
        reach *= 2
    return ended, moving


def _broken(nodes: DataFrame, circling: DataFrame, scopes: list[str]) -> DataFrame:
    """The nodes on or behind a cycle, the smallest id of each cycle without its pointer."""
    ids = circling.select(*scopes, "id")
    own = stored(nodes.alias("a").join(ids.alias("b"), _same(scopes, "id", "id"), "left_semi"), "quotes-circling")
    state, reach, most = own.withColumn("low", F.least("id", "up")), 1, own.count()
    while reach <= 2 * most:  # ``low``: the smallest id on the way
        state = stored(
            state.alias("a").join(state.alias("b"), _same(scopes, "up", "id")).select(
                *[f"a.{s}" for s in scopes], "a.id", F.col("b.up").alias("up"), F.least("a.low", "b.low").alias("low")
            ),
            "quotes-circling",
        )
        reach *= 2
    # ``up`` has long been on the cycle, and its own way is the whole cycle.
    first = state.alias("a").join(state.alias("b"), _same(scopes, "up", "id")).where(F.col("a.id") == F.col("b.low")).select(*[f"a.{s}" for s in scopes], "a.id")
    first = first.withColumn("first", F.lit(True))
    return stored(
        own.alias("a").join(first.alias("b"), _same(scopes, "id", "id"), "left")
        .select(*[f"a.{s}" for s in scopes], "a.id", F.when(F.col("b.first").isNull(), F.col("a.up")).alias("up")),
        "quotes-broken",
    )


def reply_order(linked: DataFrame, id_col: str, scope: tuple[str, ...] = ()) -> DataFrame:
    """``linked`` with ``root`` (first message of the conversation), ``depth`` (replies below it) and ``position``.

    Pointers to the answered message are doubled until each ends at a root, so the number of rounds is the logarithm of the
    deepest conversation; a message that has reached its root takes no part in later rounds. ``position`` counts from 0 by depth, then id, then text, within a root. A message that answers
    nothing is its own root. Rows that repeat an id are one message, which answers the latest that any of them does; each row
    has a position of its own. Messages that answer each other in a circle, as they can by times of their own, are cut before the one with the smallest id, which
    becomes the root. All rows stay; root and depth are null where the id is. Columns that are named like the new ones are replaced.
    """
    linked = linked.drop("root", "depth", "position")
    names = {c: f"s{i}" for i, c in enumerate(scope)}
    nodes = (
        linked.where(F.col(id_col).isNotNull())
        .select(*[F.col(c).alias(s) for c, s in names.items()], F.col(id_col).alias("id"), F.col("reply_to").alias("up"))
        .groupBy(*names.values(), "id").agg(F.max("up").alias("up"))
    )
    nodes = stored(nodes, "quotes-pointers")
    ended, circling = _followed(nodes, [*names.values()])
    if not circling.isEmpty():
        more, _ = _followed(_broken(nodes, circling, [*names.values()]), [*names.values()])
        ended = ended.unionByName(more)
    nodes = ended
    ends = nodes.select(
        *[F.col(s).alias(f"_{s}") for s in names.values()], F.col("id").alias("_id"), F.coalesce("up", "id").alias("root"), F.col("steps").alias("depth")
    )
    on = [F.col(id_col) == F.col("_id"), *[F.col(c).eqNullSafe(F.col(f"_{s}")) for c, s in names.items()]]
    within = Window.partitionBy(*scope, "root").orderBy("depth", id_col, "clean")
    return (
        linked.join(ends, on, "left")
        .drop("_id", *[f"_{s}" for s in names.values()])
        .withColumn("position", F.row_number().over(within) - 1)
    )


def as_mail(turns: DataFrame, levels: int = 3) -> DataFrame:
    """Conversation turns as a mailbox would hold them: every turn carries the ``levels`` turns before it as nested quotes.

    Of rows that repeat a turn, later turns quote the one with the smallest text; a row without a turn quotes nothing and is not
    quoted. All rows and columns stay.
    """
    said = turns.where("turn is not null").groupBy("conv_id", "turn").agg(F.min(F.coalesce("text", F.lit(""))).alias("_said"))
    thread = Window.partitionBy("conv_id").orderBy("turn")
    quotes = F.lit("")
    for n in range(levels, 0, -1):
        mark = ">" * n + " "
        quoted = F.concat(F.lit(mark), F.regexp_replace(F.lag("_said", n).over(thread), "\n", "\n" + mark), F.lit("\n"))
        quotes = F.concat(quotes, F.coalesce(quoted, F.lit("")))
    before = said.select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), quotes.alias("_quotes"))
    on = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("turn") == F.col("_turn"))
    return turns.join(before, on, "left").withColumn(
        "text", F.concat(F.coalesce("_quotes", F.lit("")), F.coalesce("text", F.lit("")))
    ).select(turns.columns)


def chat(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) as mail, linked and in reply order. Only rows that are equal in all columns are one."""
    turns = turns.select("conv_id", "turn", "role", "text").distinct()
    linked = link_quotes(as_mail(turns), "turn", scope=("conv_id",), keep=("role",))
    return reply_order(linked, "turn", scope=("conv_id",)).select(
        "conv_id", "turn", "root", F.col("position").cast("long").alias("position"), F.col("depth").cast("long").alias("depth"), "reply_to", "role",
        F.col("n_quotes").cast("long").alias("n_quotes"), F.col("n_linked").cast("long").alias("n_linked"), F.col("clean").alias("text"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat(read(spark, sf_dir, "conversations"))
