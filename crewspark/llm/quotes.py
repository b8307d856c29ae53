"""Quotation linking: conversations out of messages that quote each other.

DataFrame functions only.  Lines are read with their quote level (the number of leading
'>'); runs of lines of one level are passages.  Passages are normalised (lower-cased, white
space collapsed) and hashed; a quoted passage is joined to the message that wrote it, whole or, where it was
trimmed, by its paragraphs and lines, and the links give every message its parent, conversation, depth and text
without quotes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, table

MARKS = r"^((?:[ \t]*>)*)"
#: Words from which on a single line tells who wrote it.
LINE_WORDS = 4


def passages(messages: DataFrame) -> DataFrame:
    """``messages`` (msg_id, scope, text) with passages: array of (level, text, pieces), in text order.

    A passage is a run of lines with the same number of quote marks; text keeps its lines
    without the marks; pieces are the passage itself, its paragraphs and its lines, each as (grain, nth, hash).  Runs
    without any visible character are left out.  A null text has no passages.
    """
    line = lambda x: F.struct(F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", "")).alias("level"), F.regexp_replace(x, MARKS + " ?", "").alias("body"))
    # written, so that the steps below read these arrays instead of making them again for every element
    lines = stage(messages.select("msg_id", "scope", F.transform(F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n"), line).alias("lines")), "quote-lines")
    level = "lines[{}].level"
    runs = lines.where("lines is not null") \
        .withColumn("first", F.expr(f"filter(sequence(0, size(lines) - 1), i -> i = 0 or {level.format('i')} <> {level.format('i - 1')})")) \
        .withColumn("last", F.expr(f"filter(sequence(0, size(lines) - 1), i -> i = size(lines) - 1 or {level.format('i')} <> {level.format('i + 1')})"))
    texts = runs.withColumn("runs", F.expr(
        "transform(arrays_zip(first, last), r -> named_struct('level', lines[r.first].level, 'text', array_join(transform(slice(lines, r.first + 1, r.last - r.first + 1), x -> x.body), '\n')))"))
    seen = F.filter("runs", lambda r: r["text"].rlike(r"\S"))
    return texts.select("msg_id", "scope", F.transform(seen, lambda r: F.struct(r["level"].alias("level"), r["text"].alias("text"), pieces(r["text"]).alias("pieces"))).alias("passages"))


def plain(text):
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def pieces(text):
    """(grain, nth, hash) of a passage: 0 the whole, 1 its paragraphs (cut at blank lines), 2 its lines of LINE_WORDS words or more."""
    piece = lambda grain: lambda x, i: F.struct(F.lit(grain).alias("grain"), i.alias("nth"), F.md5(x.cast("binary")).alias("hash"))
    part = lambda array, pattern: F.filter(F.transform(array, plain), lambda x: x.rlike(pattern))
    whole = F.transform(F.array(plain(text)), piece(0))
    return F.concat(whole, F.transform(part(F.split(text, "\n[ \t]*\n"), "."), piece(1)), F.transform(part(F.split(text, "\n"), f"^([^ ]+ ){{{LINE_WORDS - 1}}}[^ ]"), piece(2)))


def fingerprint(text):
    return F.md5(plain(text).cast("binary"))


def link_quotes(messages: DataFrame) -> DataFrame:
    """(msg_id, root_id, parent_id, depth, n_passages, n_linked, own_text): a row for every message.

    ``messages``: msg_id (ascending with time), scope (the list or folder whose messages may
    quote each other; null is a scope of its own) and text.  The original of a quoted passage
    is the earliest message of the scope that wrote it, as a whole own passage, as all of its own text, or as a
    paragraph or line of an own passage, if that is earlier than the quoting one; where the passage as a whole
    has none, that of its first paragraph that has one, else of its first line of LINE_WORDS words or more that has one.
    A message's parent is the original
    of its least deeply quoted linked passage, of several the first.  Messages without a
    parent open a conversation.  own_text is what the message itself wrote: its unquoted
    passages, one after the other (empty for null, empty or fully quoted texts).
    n_passages and n_linked count quoted passages and those with an original.  Rows that repeat
    a msg_id count as one, the least by (scope, text); rows without one are left out; extra columns are
    ignored; an empty table gives an empty result.  A conversation is as many rows, in
    no task or value together; order by root_id, depth, msg_id to read it.
    """
    one = messages.where("msg_id is not null").groupBy(F.col("msg_id").cast("long").alias("msg_id")).agg(F.min(F.struct(F.struct("scope").alias("scope"), "text")).alias("m")) \
        .select("msg_id", "m.scope", "m.text")
    read = stage(passages(one), "quote-passages")
    part = read.select("msg_id", "scope", F.posexplode("passages").alias("place", "p")).select("msg_id", "scope", "place", "p.level", F.explode("p.pieces").alias("piece")).select("msg_id", "scope", "place", "level", "piece.*")
    own_text = F.array_join(F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: p["text"]), "\n")
    own = stage(read.select("msg_id", "scope", own_text.alias("own_text"), F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("long").alias("n_passages")), "quote-own")

    wrote = part.where("level = 0").select("scope", "hash", "msg_id").unionByName(own.where(F.col("own_text") != "").select("scope", fingerprint("own_text").alias("hash"), "msg_id"))
    originals = wrote.groupBy("scope", "hash").agg(F.min("msg_id").alias("origin"))
    linked = part.where("level > 0").join(originals, ["scope", "hash"]).where("origin < msg_id") \
        .groupBy("msg_id", "level", "place").agg(F.min(F.struct("grain", "nth", "origin"))["origin"].alias("origin"))
    parents = linked.groupBy("msg_id").agg(F.min(F.struct("level", "place", "origin"))["origin"].alias("parent_id"), F.count(F.lit(1)).alias("n_linked"))
    joined = one.select("msg_id").join(own, "msg_id", "left").join(parents, "msg_id", "left") \
        .select("msg_id", "parent_id", F.coalesce("n_passages", F.lit(0)).cast("long").alias("n_passages"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.coalesce("own_text", F.lit("")).alias("own_text"))
    joined = stage(joined, "quote-parents")
    ends = conversation_roots(joined.select("msg_id", "parent_id"))
    return joined.join(ends, "msg_id").select("msg_id", "root_id", "parent_id", "depth", "n_passages", "n_linked", "own_text")


def conversation_roots(links: DataFrame) -> DataFrame:
    """(msg_id, root_id, depth) from (msg_id, parent_id) by doubling: a thread of depth d takes
    log2(d) joins, each of the messages that have not reached their root yet."""
    root = F.col("parent_id").isNull()
    at = links.select("msg_id", F.coalesce("parent_id", "msg_id").alias("up"), F.when(root, 0).otherwise(1).cast("long").alias("steps"), root.alias("done"))
    while not at.where("not done").isEmpty():
        ahead = at.select(F.col("msg_id").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("done").alias("end"))
        moved = at.where("not done").join(ahead, "up").select("msg_id", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), F.col("end").alias("done"))
        at = stage(at.where("done").unionByName(moved), "quote-roots")
    return at.select("msg_id", F.col("up").alias("root_id"), F.col("steps").alias("depth"))


def quoting_messages(conversations: DataFrame) -> DataFrame:
    """Messages out of turns: a turn quotes the one before it, which quotes the one before that; turns of odd number quote only the last line of each.

    Rows that repeat a (conv_id, turn) count as one turn, the least by text; rows without a conv_id or turn are no
    messages.  msg_id is conv_id * 2**20 + turn, so turns are numbered from 0 to 2**20 - 1.
    """
    turns = conversations.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    quoted = F.when(F.pmod("turn", F.lit(2)) == 1, F.substring_index("said", "\n", -1)).otherwise(F.col("said"))
    back = lambda k: turns.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("text").alias("said")) \
        .select("conv_id", "turn", F.concat(F.lit(">" * k + " "), F.regexp_replace(quoted, "\n", "\n" + ">" * k + " ")).alias(f"back{k}"))
    return turns.join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left") \
        .select((F.col("conv_id") * (1 << 20) + F.col("turn")).alias("msg_id"), F.col("conv_id").alias("scope"), F.concat_ws("\n", "back2", "back1", "text").alias("text"))


def op3_quotation_linking(spark, sf_dir):
    """Conversations rebuilt from the quotes of every turn of the conversations table; edge cases as in ``quoting_messages`` and ``link_quotes``."""
    return link_quotes(quoting_messages(table(spark, sf_dir, "conversations")))


#: The same rules over unnested lines; roots and depths by recursion.
ORACLE_3 = r"""
WITH RECURSIVE turns AS (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY ALL),
m AS (
  SELECT t.conv_id * 1048576 + t.turn AS msg_id, t.conv_id AS scope,
    concat_ws(chr(10), '>> ' || replace(CASE WHEN t.turn % 2 = 1 THEN string_split(b.text, chr(10))[-1] ELSE b.text END, chr(10), chr(10) || '>> '),
      '> ' || replace(CASE WHEN t.turn % 2 = 1 THEN string_split(a.text, chr(10))[-1] ELSE a.text END, chr(10), chr(10) || '> '), t.text) AS text
  FROM turns t LEFT JOIN turns a ON a.conv_id = t.conv_id AND a.turn = t.turn - 1 LEFT JOIN turns b ON b.conv_id = t.conv_id AND b.turn = t.turn - 2
), l AS (SELECT msg_id, scope, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM m),
lv AS (SELECT msg_id, scope, i, len(regexp_replace(regexp_extract(line, '^((?:[ \t]*>)*)', 1), '[^>]', '', 'g')) AS level, regexp_replace(line, '^((?:[ \t]*>)*) ?', '') AS body FROM l),
ch AS (SELECT *, coalesce(level <> lag(level) OVER (PARTITION BY msg_id ORDER BY i), true)::INT AS new FROM lv),
rn AS (SELECT *, sum(new) OVER (PARTITION BY msg_id ORDER BY i) AS run FROM ch),
p AS (SELECT msg_id, scope, run AS place, level, string_agg(body, chr(10) ORDER BY i) AS text FROM rn GROUP BY ALL HAVING regexp_matches(string_agg(body, chr(10)), '\S')),
own AS (SELECT msg_id, any_value(scope) AS scope, coalesce(string_agg(text, chr(10) ORDER BY place) FILTER (level = 0), '') AS own_text, count(*) FILTER (level > 0) AS n_passages FROM p GROUP BY msg_id),
cut AS (
  SELECT msg_id, scope, place, level, 0 AS grain, 1 AS nth, text AS piece FROM p
  UNION ALL SELECT msg_id, scope, place, level, 1, generate_subscripts(x, 1), unnest(x) FROM (SELECT *, regexp_split_to_array(text, '\n[ \t]*\n') AS x FROM p)
  UNION ALL SELECT msg_id, scope, place, level, 2, generate_subscripts(x, 1), unnest(x) FROM (SELECT *, string_split(text, chr(10)) AS x FROM p)
),
h AS (SELECT msg_id, scope, place, level, grain, nth, md5(piece) AS hash FROM (SELECT * REPLACE (trim(regexp_replace(lower(piece), '\s+', ' ', 'g')) AS piece) FROM cut)
  WHERE grain = 0 OR grain = 1 AND piece <> '' OR grain = 2 AND len(string_split(piece, ' ')) >= 4),
orig AS (
  SELECT scope, hash, min(msg_id) AS origin FROM (
    SELECT scope, hash, msg_id FROM h WHERE level = 0
    UNION ALL SELECT scope, md5(trim(regexp_replace(lower(own_text), '\s+', ' ', 'g'))), msg_id FROM own WHERE own_text <> '') GROUP BY ALL
), linked AS (SELECT h.msg_id, level, place, arg_min(origin, (grain, nth)) AS origin FROM h JOIN orig ON orig.hash = h.hash AND orig.scope IS NOT DISTINCT FROM h.scope WHERE level > 0 AND origin < h.msg_id GROUP BY ALL),
par AS (SELECT msg_id, arg_min(origin, level * 1000000 + place) AS parent_id, count(*) AS n_linked FROM linked GROUP BY msg_id),
up(msg_id, root_id, depth) AS (
  SELECT m.msg_id, m.msg_id, 0 FROM m WHERE msg_id NOT IN (SELECT msg_id FROM par)
  UNION ALL SELECT par.msg_id, up.root_id, up.depth + 1 FROM par JOIN up ON up.msg_id = par.parent_id
)
SELECT up.msg_id, up.root_id, par.parent_id, up.depth::BIGINT AS depth, coalesce(own.n_passages, 0)::BIGINT AS n_passages, coalesce(par.n_linked, 0)::BIGINT AS n_linked, coalesce(own.own_text, '') AS own_text
FROM up LEFT JOIN own ON own.msg_id = up.msg_id LEFT JOIN par ON par.msg_id = up.msg_id
"""

QUERIES = {"op3_quotation_linking": op3_quotation_linking}
ORACLES = {"op3_quotation_linking": ORACLE_3}
