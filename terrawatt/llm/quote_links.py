"""Chat formatting by quotation linking: replies find the messages they quote and lose the quotes.

A message's lines carry nested quote marks (`>`, `> >`, `>>`). Lines of one level form passages; a
passage is hashed in a normal form (lower case, single spaces), as a whole and line by line, so that
partly quoted or rewrapped passages still meet. Quoted hashes are joined to the hashes of what earlier
messages of the conversation wrote themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawatt.llm.ranking import ranked_by_sort
from terrawatt.llm.scratch import Scratch

_PREFIX = re.compile(r"^(?:[ \t]*>)+")
#: Fixed form: the line that mail programs put before a quotation.
_INTRO = re.compile(r"^\s*(?:on\b.{0,200}\bwrote|.{0,80}\bschrieb.{0,80}|le\b.{0,200}\ba écrit)\s*:\s*$", re.IGNORECASE)


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """(text without quotes, passages as (quote level, normal form)); level 0 is what the message says itself.

    Passages are runs of lines of one level without a blank line, followed by their lines if there is
    more than one. An attribution line directly above a quotation goes with the quotation.
    """
    own, passages, run, level_of_run = [], [], [], 0

    def close() -> None:
        if run:
            forms = [" ".join(line.lower().split()) for line in run]
            whole = " ".join(forms)
            passages.append((level_of_run, whole))
            if len(forms) > 1:
                passages.extend((level_of_run, f) for f in forms)
            run.clear()

    for line in (text or "").split("\n"):
        mark = _PREFIX.match(line)
        level = mark.group().count(">") if mark else 0
        body = line[mark.end() :] if mark else line
        if level and not level_of_run:  # a quotation starts: drop the line that introduces it
            while own and not own[-1].strip():
                own.pop()
            if own and _INTRO.match(own[-1]):
                gone = own.pop()
                if run and run[-1] == gone:
                    run.pop()
        if level != level_of_run or not body.strip():
            close()
            level_of_run = level
        if body.strip():
            run.append(body)
        if not level:
            own.append(line)
    close()
    return "\n".join(own).strip(), passages


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        clean, wrote, quoted = [], [], []
        for text in batch.column("text").to_pylist():
            body, passages = parse(text)
            clean.append(body)
            coded = [(level, xxhash.xxh3_64_intdigest(form) - (1 << 63), len(form)) for level, form in passages if form]
            wrote.append(sorted({h for level, h, _ in coded if not level}))
            quoted.append([{"level": level, "hash": h, "chars": c} for level, h, c in sorted({x for x in coded if x[0]})])
        links = pa.array(quoted, pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("chars", pa.int64())])))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv", "turn", "role")), pa.array(clean, pa.string()), pa.array(wrote, pa.list_(pa.int64())), links],
            names=["conv", "turn", "role", "clean", "wrote", "quoted"],
        )


def reply_links(messages: DataFrame) -> DataFrame:
    """(conv, turn, parent, n_linked) of `messages` (conv, turn, wrote, quoted) that quote an earlier one.

    The author of a passage is the first message of the conversation that wrote it. A message's parent
    is the author of most characters among its shallowest linked quotes, the later one on a tie:
    what is quoted one level deep is answered, deeper levels only lead back further.
    """
    known = messages.where("conv IS NOT NULL AND turn IS NOT NULL")
    authors = known.select("conv", "turn", F.explode("wrote").alias("hash")).groupBy("conv", "hash").agg(F.min("turn").alias("author"))
    quotes = known.select("conv", "turn", F.inline("quoted")).distinct()
    found = quotes.join(authors, ["conv", "hash"]).where("author < turn")
    weighed = found.groupBy("conv", "turn", "level", "author").agg(F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n"))
    best = F.struct(-F.col("level"), F.col("chars"), F.col("author"))
    return weighed.groupBy("conv", "turn").agg(F.max_by("author", best).alias("parent"), F.sum("n").alias("n_linked"))


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, root, depth) of every linked message, by pointer doubling: rounds grow with the logarithm of the depth."""
    scratch = Scratch(links.sparkSession, "threads")
    at = scratch.keep(links.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "0")
    k = 0
    while True:
        up = at.select("conv", F.col("turn").alias("root"), F.col("root").alias("further"), F.col("depth").alias("more"))
        open_rows = at.join(up, ["conv", "root"], "left")
        k += 1
        at_next = scratch.keep(
            open_rows.select("conv", "turn", F.coalesce("further", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("further").isNotNull().alias("moved")), str(k)
        )
        scratch.drop(str(k - 1))
        at = at_next.drop("moved")
        if at_next.where("moved").isEmpty():
            return at


def link_quotations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: conv, turn, role, position, parent_turn, root_turn, depth, n_quoted, n_linked, clean text.

    `position` numbers a conversation's messages from 0, thread by thread: by the turn of the thread's
    first message, then by turn, so that a reply follows what it answers; a message that quotes
    nothing known starts a thread of its own. `n_quoted` counts distinct quoted passages and lines,
    `n_linked` those with a known author. Messages without a turn come last in their conversation,
    and like those without a conversation are not linked. Rows that repeat a turn share its links and
    each keep a row. A null text is an empty message. Other columns of the input are ignored.
    """
    scratch = Scratch(messages.sparkSession, "quotes")
    slim = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    kind = slim.schema["conv"].dataType.simpleString()
    parsed = slim.mapInArrow(_parsed, f"conv {kind}, turn long, role {slim.schema['role'].dataType.simpleString()}, clean string, wrote array<long>, quoted array<struct<level: int, hash: long, chars: long>>")
    parsed = scratch.keep(parsed, "parsed")
    links = scratch.keep(reply_links(parsed), "links")
    placed = links.join(threads(links), ["conv", "turn"])
    rows = parsed.select("conv", "turn", "role", "clean", F.size("quoted").cast("long").alias("n_quoted")).join(placed, ["conv", "turn"], "left")
    rows = rows.select(
        "conv", "turn", "role", "clean", "n_quoted", F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "parent",
        F.coalesce("root", "turn").alias("root"), F.coalesce("depth", F.lit(0)).alias("depth"), F.md5(F.concat_ws("|", "role", "clean")).alias("tie"),
    )
    ordered = ranked_by_sort(rows, "conv", ["root", "turn", "tie"], "position")
    return ordered.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "position",
        F.col("parent").alias("parent_turn"), F.col("root").alias("root_turn"), "depth", "n_quoted", "n_linked", F.col("clean").alias(text_col),
    )
