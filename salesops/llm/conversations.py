"""Conversations from messages that quote each other.

A message's lines are read with their quote level (the number of leading ``>``).
Runs of lines of one level are passages; those of level 0 are the message's own
text, without the line that announces a quote ("... wrote:"). Quoted passages
and own texts are normalised (lower case, single spaces) and hashed. A quoted
passage belongs to the latest earlier message of its scope whose own text, or a
passage of it, has the same hash; the passage of level 1 names the message that
is answered. Following these links to the first message gives each message its
conversation and its depth; quotes are taken out of the text.

Passages meet originals by an as-of lookup, not by pairs: within stretches of
``STRETCH`` positions by a window, and over stretches by the last original of
each, so that a passage or a scope with very many messages is spread over many
groups of bounded size.

Defined cases: a null text is an empty message; empty passages are not linked;
messages without scope or position stand alone; repeated rows appear each, and
share the position's answers; a quote without an original stays unlinked; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesops.session import materialize

STRETCH = 64
_QUOTED = re.compile(r"^\s*((?:>\s?)+)")
_ANNOUNCED = re.compile(r"\bwrote:\s*$")
_BLANK = " \t\n\r\x0b\x0c"


def passages(text: str | None) -> list[tuple[int, str]]:
    """Runs of lines of one quote level, without the marks: (level, text)."""
    found: list[tuple[int, list[str]]] = []
    for line in (text or "").split("\n"):
        mark = _QUOTED.match(line)
        level = mark[1].count(">") if mark else 0
        if found and found[-1][0] == level:
            found[-1][1].append(line[mark.end() :] if mark else line)
        else:
            if level and found and found[-1][0] < level and found[-1][1] and _ANNOUNCED.search(found[-1][1][-1]):
                found[-1][1].pop()
                if not found[-1][1]:
                    found.pop()
            found.append((level, [line[mark.end() :] if mark else line]))
    return [(level, "\n".join(lines)) for level, lines in found]


def passage_hash(text: str) -> int | None:
    """64-bit hash of the normalised text; None without words."""
    plain = " ".join(text.lower().split())
    return int.from_bytes(hashlib.blake2b(plain.encode(), digest_size=8).digest(), "big", signed=True) if plain else None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own_texts, own_hashes, quotes = [], [], []
        for value in batch.column(2):
            found = passages(value.as_py())
            own = [text for level, text in found if level == 0]
            whole = "\n".join(own).strip(_BLANK)
            own_texts.append(whole)
            own_hashes.append(list({h for h in map(passage_hash, [whole, *own]) if h is not None}))
            hashed = [(level, passage_hash(text)) for level, text in found if level]
            quotes.append([{"level": level, "hash": h} for level, h in hashed if h is not None])
        kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(own_texts, pa.string()),
                pa.array(own_hashes, pa.list_(pa.int64())), pa.array(quotes, kind),
            ],
            names=["scope", "position", "own_text", "own_hashes", "quotes"],
        )


def _latest_before(originals: DataFrame, quotes: DataFrame) -> DataFrame:
    """The quotes with ``found``, the position of the latest earlier original of their scope and hash."""
    stretch = F.floor(F.col("position") / STRETCH).alias("stretch")
    key = ["scope", "hash"]
    given = originals.select(*key, stretch, "position").distinct()
    asked = quotes.select(*key, stretch, "position").distinct()
    both = given.withColumn("original", F.col("position")).unionByName(
        asked.withColumn("original", F.lit(None).cast("long"))
    )
    inside = Window.partitionBy(*key, "stretch").orderBy("position").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max("original").over(inside)).where("original is null").drop("original")
    ends = both.groupBy(*key, "stretch").agg(F.max("original").alias("last"))
    ahead = Window.partitionBy(*key).orderBy("stretch").rangeBetween(Window.unboundedPreceding, -1)
    far = ends.withColumn("far", F.max("last").over(ahead)).drop("last")
    answered = near.join(far, [*key, "stretch"], "left").select(*key, "position", F.coalesce("near", "far").alias("found"))
    return quotes.join(answered, [*key, "position"], "left")


def _rooted(parents: DataFrame) -> DataFrame:
    """From (scope, position, parent): ``root`` and ``depth``, by doubling the steps taken."""
    state = materialize(
        parents.select(
            "scope", "position", "parent", F.coalesce("parent", "position").alias("root"),
            F.col("parent").isNotNull().cast("long").alias("depth"),
        )
    )
    ended = state.limit(0)
    while True:
        # Only messages that moved go on; a short conversation is done after a few rounds.
        up = state.unionByName(ended).select(
            "scope", F.col("position").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more")
        )
        moved = materialize(
            state.join(up, ["scope", "root"], "left").select(
                "scope", "position", "parent", F.coalesce("above", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                (F.coalesce("above", "root") != F.col("root")).alias("moved"),
            )
        )
        ended = ended.unionByName(moved.where("not moved").drop("moved"))
        state = moved.where("moved").drop("moved")
        if state.isEmpty():
            return ended


def link_quotes(
    messages: DataFrame, scope: str = "conv_id", position: str = "turn", text: str = "text"
) -> DataFrame:
    """Per message: scope, position, ``parent`` (position of the message it answers), ``root`` and ``depth``
    (its conversation and its place in it; a parent always comes before), ``n_quotes``, ``n_linked``
    (quoted passages, and those whose original was found), ``deepest`` (quote level) and ``own_text``.

    Sorting by scope, root and position gives the conversations in reply order.
    """
    parsed = materialize(
        messages.select(
            F.col(f"`{scope}`").cast("long").alias("scope"), F.col(f"`{position}`").cast("long").alias("position"),
            F.col(f"`{text}`").cast("string").alias("text"),
        ).mapInArrow(
            _parse,
            "scope long, position long, own_text string, own_hashes array<long>, quotes array<struct<level:int,hash:long>>",
        )
    )
    placed = parsed.where("scope is not null and position is not null")
    originals = placed.select("scope", "position", F.explode("own_hashes").alias("hash"))
    quotes = placed.select("scope", "position", F.explode("quotes").alias("q")).select("scope", "position", "q.level", "q.hash")
    linked = _latest_before(originals, quotes.distinct())
    answers = linked.groupBy("scope", "position").agg(
        F.max(F.when(F.col("level") == 1, F.col("found"))).alias("parent"),
        F.count("found").alias("n_linked"),
    )
    places = placed.select("scope", "position").distinct().join(answers, ["scope", "position"], "left")
    rooted = _rooted(places.select("scope", "position", "parent"))
    counted = answers.select("scope", "position", "n_linked")
    return (
        parsed.join(rooted, ["scope", "position"], "left")
        .join(counted, ["scope", "position"], "left")
        .select(
            F.col("scope").alias(scope), F.col("position").alias(position), "parent",
            F.coalesce("root", "position").alias("root"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
            F.size("quotes").cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
            F.coalesce(F.array_max(F.transform("quotes", lambda q: q["level"])), F.lit(0)).cast("long").alias("deepest"),
            "own_text",
        )
    )


def as_mail(turns: DataFrame, scope: str = "conv_id", position: str = "turn", text: str = "text") -> DataFrame:
    """Turns as mail: each quotes the turn before it and, one level deeper, the turn before that.

    Quotes that are gone from given conversations are put back, so that there is
    something to link. Of repeated turns one text is quoted, the smallest.
    """
    plain = turns.select(F.col(f"`{scope}`").alias("scope"), F.col(f"`{position}`").alias("position"), F.col(f"`{text}`").alias("text"))
    one = materialize(plain.groupBy("scope", "position").agg(F.min("text").alias("text")))
    before = [
        one.select("scope", (F.col("position") + back).alias("position"), F.col("text").alias(f"back{back}")) for back in (1, 2)
    ]

    def quoted(column: str, mark: str):
        return F.when(F.col(column).rlike(r"\S"), F.concat(F.lit(mark), F.regexp_replace(column, "\n", f"\n{mark}")))

    body = F.concat_ws(
        "\n", F.when(F.col("back1").rlike(r"\S"), F.lit("The turn before wrote:")), quoted("back2", "> > "), quoted("back1", "> "),
        F.col("text"),
    )
    joined = plain.join(before[0], ["scope", "position"], "left").join(before[1], ["scope", "position"], "left")
    return joined.select(F.col("scope").alias(scope), F.col("position").alias(position), body.alias(text))
