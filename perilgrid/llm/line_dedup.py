"""Line dedup: lines equal to an earlier line up to a few edits, by a segment-partition join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilgrid.session import new_dir

EDITS = 2
# Lines of fewer characters have no edits to spare: they are repeats only where they are equal.
MIN_CHARS = 40
BLANK = " \t\r"  # a line of nothing else is no repeat
# Shared segment keys that may be broadcast (16 bytes each); beyond it a filter of them is.
BROADCAST_KEYS = 1 << 20
FILTER_ROWS = 1 << 13  # rows of the filter at most, each of FILTER_WORDS longs: 32 MB
FILTER_WORDS = 512
FILTER_BITS = (13, 28, 43)  # the lowest bits of a key name its row of the filter, those from here its bits there
FILTER_SHARE = 64  # bits of the filter for a key
# Characters whose parities make the signature that rules out pairs before they are compared.
SIGNATURE = "abcdefghijklmnopqrstuvwxyz0123456789"


def _segments(length: str, edits: int) -> list[tuple[str, str]]:
    """(start, length) of the ``edits + 1`` segments of a line of the given length, as SQL."""
    parts = edits + 1
    sizes = [f"({length} + {i}) div {parts}" for i in range(parts)]
    return [(" + ".join(["0", *sizes[:i]]), sizes[i]) for i in range(parts)]


def segment_keys(line: str, edits: int) -> str:
    """SQL array of (key, own): the line's own segments and the substrings it probes with.

    A line of n characters probes lines of n - gap characters, gap = 0 .. edits, at the places
    where their segment can still lie within the edits left for both sides of it; of the matching
    segments of a pair at least one is met there. Keys hash length, segment number and substring.
    """
    parts = edits + 1
    entries = []
    for gap in range(edits + 1):
        length = f"length({line}) - {gap}"
        for i, (start, size) in enumerate(_segments(f"({length})", edits)):
            low = max(-i, gap - (parts - 1 - i))
            high = min(i, gap + (parts - 1 - i))
            for shift in range(low, high + 1):
                own = "true" if gap == 0 and shift == 0 else "false"
                entries.append(
                    f"named_struct('key', xxhash64(CAST({length} AS INT), {i}, "
                    f"substring({line}, CAST({start} + {shift} + 1 AS INT), CAST({size} AS INT))), 'own', {own})"
                )
    return f"array({', '.join(entries)})"


def _signature(line: str) -> Column:
    """Bit k: parity of the number of the k-th character; one edit changes at most two bits."""
    bits = [
        f"shiftleft(CAST((length({line}) - length(replace({line}, '{c}', ''))) % 2 AS BIGINT), {k})"
        for k, c in enumerate(SIGNATURE)
    ]
    return F.expr(" | ".join(bits))


def _common_prefix(a: str, b: str) -> str:
    """SQL for the length of the common prefix of two strings, by bisection."""
    limit = f"least(length({a}), length({b}))"
    return f"""aggregate(sequence(30, 0), 0, (n, k) ->
        CASE WHEN n + shiftleft(1, k) <= {limit}
              AND substring({a}, n + 1, shiftleft(1, k)) = substring({b}, n + 1, shiftleft(1, k))
             THEN n + shiftleft(1, k) ELSE n END)"""


def within_edits(pairs: DataFrame, a: str, b: str, edits: int) -> DataFrame:
    """The rows whose strings ``a`` and ``b`` differ by at most ``edits`` edits.

    Common ends are cut off; the rest is compared by the banded bit-parallel recurrence: one word
    of 2 * edits + 1 bits holds the vertical differences of the diagonal band, and moves one row
    down with every character of ``b``.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    # each inline() is a step of its own, so that no later expression repeats an earlier one
    rows = pairs.select("*", F.expr(f"inline(array(named_struct('_p', {_common_prefix(a, b)})))"))
    rows = rows.select("*", F.expr(f"inline(array(named_struct('_x', substring({a}, _p + 1), '_y', substring({b}, _p + 1))))"))
    rows = rows.select("*", F.expr("inline(array(named_struct('_rx', reverse(_x), '_ry', reverse(_y))))"))
    rows = rows.select("*", F.expr(f"inline(array(named_struct('_s', {_common_prefix('_rx', '_ry')})))"))
    # one element for each code point
    points = [f"'{c}', regexp_extract_all(substring({r}, 1, length({r}) - _s), '(?s).', 0)" for c, r in (("_a", "_x"), ("_b", "_y"))]
    rows = rows.select(*pairs.columns, F.expr(f"inline(array(named_struct({', '.join(points)})))"))
    match = " | ".join(
        f"CASE WHEN coalesce(get(_a, i + {k - edits}) = get(_b, i), false) THEN {1 << k}L ELSE 0L END"
        for k in range(width)
    )
    match = match.replace("CASE", "(CASE").replace("END", "END)")
    # state: vp, vn and the distance; before row size(_a) - edits it follows the lowest diagonal,
    # then the last row
    step = f"""transform(array({match}), pm ->
        transform(array((((((pm & s.vp) + s.vp) ^ s.vp) | pm | s.vn) & {full}L)), d0 ->
          transform(array(named_struct('hp', (s.vn | ~(d0 | s.vp)) & {full}L, 'hn', d0 & s.vp)), h ->
            named_struct(
              'vp', (h.hn | ~(shiftright(d0, 1) | h.hp)) & {full}L,
              'vn', shiftright(d0, 1) & h.hp,
              'dist', s.dist + CASE
                WHEN i < size(_a) - {edits} THEN CASE WHEN d0 & {1 << (width - 1)}L = 0 THEN 1 ELSE 0 END
                ELSE CASE WHEN h.hp & shiftright({1 << (width - 2)}L, i - greatest(size(_a) - {edits}, 0)) <> 0 THEN 1 ELSE 0 END
                   - CASE WHEN h.hn & shiftright({1 << (width - 2)}L, i - greatest(size(_a) - {edits}, 0)) <> 0 THEN 1 ELSE 0 END
                END))[0])[0])[0]"""
    start = f"named_struct('vp', {((1 << (edits + 1)) - 1) << edits}L, 'vn', 0L, 'dist', {edits})"
    loop = f"aggregate(sequence(0, size(_b) - 1), {start}, (s, i) -> {step}, s -> s.dist)"
    # a rest within the band is compared directly
    short = f"size(_a) <= {edits} OR size(_b) <= {edits}"
    direct = "levenshtein(array_join(_a, ''), array_join(_b, ''))"
    verdict = f"CASE WHEN {short} THEN {direct} ELSE {loop} END <= {edits}"
    rows = rows.select(*pairs.columns, F.expr(f"inline(array(named_struct('_near', {verdict})))"))
    return rows.where("_near").drop("_near")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, h_text, line_no, line, h1, h2) of the lines that are not blank."""
    lines = docs.select(
        "doc_id",
        F.xxhash64("text").alias("h_text"),
        F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"),
    ).where(F.btrim("line", F.lit(BLANK)) != "")
    return lines.withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), "line"))


def _filter_places(rows: int) -> list[str]:
    """SQL for the number of a key's row of the filter and the numbers of its bits there."""
    bits = FILTER_WORDS * 64
    return [f"key & {rows - 1}L", *(f"shiftrightunsigned(key, {at}) & {bits - 1}L" for at in FILTER_BITS)]


def key_filter(keys: DataFrame, count: int) -> tuple[DataFrame, int]:
    """(_row, _words) and the number of rows: a Bloom filter of ``key``, all bits of one in one row.

    It has FILTER_SHARE bits a key or more, as long as FILTER_ROWS allow.
    """
    rows = min(FILTER_ROWS, 1 << max(count * FILTER_SHARE // (FILTER_WORDS * 64), 1).bit_length())
    row, *places = _filter_places(rows)
    bits = keys.selectExpr(f"({row}) * {FILTER_WORDS * 64} AS _start", f"explode(array({', '.join(places)})) AS _bit")
    masks = bits.selectExpr("shiftright(_start + _bit, 6) AS _word", "shiftleft(1L, CAST(_bit & 63 AS INT)) AS _mask")
    empty = keys.sparkSession.range(rows * FILTER_WORDS).selectExpr("id AS _word", "0L AS _mask")
    words = masks.union(empty).groupBy("_word").agg(F.expr("bit_or(_mask) AS _mask"))
    dense = F.expr("transform(array_sort(collect_list(struct(_word, _mask))), w -> w._mask) AS _words")
    return words.groupBy(F.expr(f"_word div {FILTER_WORDS} AS _row")).agg(dense), rows


def in_filter(keyed: DataFrame, words: DataFrame, rows: int) -> DataFrame:
    """The rows of ``keyed`` whose key the filter holds, and few others."""
    row, *places = _filter_places(rows)
    set_ = [f"getbit(_words[CAST(shiftright({p}, 6) AS INT)], CAST(({p}) & 63 AS INT)) = 1" for p in places]
    met = keyed.join(F.broadcast(words), F.expr(f"_row = ({row})")).where(" AND ".join(set_))
    return met.select(*keyed.columns)


def near_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, g1, g2): pairs of different lines, by hash, within ``edits`` edits of each other.

    First the segment keys of all lines are reduced to those that different lines share (counted
    per task before the shuffle); only lines with such a key go on. Where these keys are too many to
    broadcast, a Bloom filter of them is, so that lines are never shuffled once for each of their keys;
    the few that it lets pass wrongly meet no other line. Index rows (own segments) meet the probing
    rows by key, a character signature rules out most pairs inside the join, and the rest is verified
    by the edit distance.
    """
    spark = docs.sparkSession
    keyed = _lines(docs).where(F.length("line") >= min_chars).select("h1", "h2", "line", F.explode(F.expr(segment_keys("line", edits))).alias("k"))
    keyed = keyed.select("h1", "h2", "line", "k.key", "k.own")
    shared = keyed.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    path = new_dir(spark, "segment-keys")
    shared.where("low <> high").select("key").write.parquet(path)
    shared = spark.read.parquet(path)
    count = shared.count()
    if count <= BROADCAST_KEYS:
        met = keyed.join(F.broadcast(shared), "key", "left_semi")
    else:
        met = in_filter(keyed, *key_filter(shared, count))
    # equal lines are one row from here on
    met = met.groupBy("key", "own", "h1", "h2").agg(F.first("line").alias("line"))
    path = new_dir(spark, "segment-rows")
    met.withColumn("sig", _signature("line")).write.parquet(path)
    rows = spark.read.parquet(path)
    own = rows.where("own").select("key", *(F.col(c).alias(f"b_{c}") for c in ("h1", "h2", "line", "sig")))
    pairs = rows.join(own, "key").where(
        f"(h1 <> b_h1 OR h2 <> b_h2) AND bit_count(sig ^ b_sig) <= {2 * edits}"
    )
    pairs = pairs.groupBy("h1", "h2", F.col("b_h1").alias("g1"), F.col("b_h2").alias("g2")).agg(
        F.first("line").alias("a"), F.first("b_line").alias("b")
    )
    found = within_edits(pairs, "a", "b", edits).select("h1", "h2", "g1", "g2")
    return found.union(found.select("g1", "g2", "h1", "h2")).distinct()


def repeated_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, h_text, removed): numbers of the lines to remove, for rows that have any.

    ``h_text`` is xxhash64 of the row's text. A line goes if an earlier line, in order of doc_id,
    text hash and line number, is equal to it, or if a line within ``edits`` edits of it appears
    earlier than all lines equal to it.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    links_at, lines_at = new_dir(spark, "near-lines"), new_dir(spark, "lines")
    near_lines(docs, edits, min_chars).write.parquet(links_at)
    _lines(docs).drop("line").write.parquet(lines_at)
    links, lines = spark.read.parquet(links_at), spark.read.parquet(lines_at)
    place = F.struct("doc_id", "h_text", "line_no")
    first = lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    ends = links.select("h1", "h2").distinct()
    linked = first.join(ends, ["h1", "h2"], "left_semi").select("h1", "h2", "first")
    other = linked.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("first").alias("g_first"))
    earliest = links.join(other, ["g1", "g2"]).groupBy("h1", "h2").agg(F.min("g_first").alias("g_first"))
    judged = first.join(earliest, ["h1", "h2"], "left")
    judged = judged.withColumn("gone", F.coalesce(F.col("g_first") < F.col("first"), F.lit(False)))
    # written, so that both sides of the next join are plain shuffles: Spark splits a line that
    # very many documents share, and broadcasts the list where it is short
    path = new_dir(spark, "judged-lines")
    judged.where("gone OR n > 1").select("h1", "h2", "first", "gone").write.parquet(path)
    out = lines.join(spark.read.parquet(path), ["h1", "h2"]).where(F.col("gone") | ~place.eqNullSafe(F.col("first")))
    return out.groupBy("doc_id", "h_text").agg(F.collect_set("line_no").alias("removed"))


def _rebuilt(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """(doc_id, text, ...) with the column ``_removed`` (null where nothing goes)."""
    gone = repeated_lines(docs, edits, min_chars).select(
        F.col("doc_id").alias("_doc_id"), F.col("h_text").alias("_h_text"), F.col("removed").alias("_removed")
    )
    same = docs["doc_id"].eqNullSafe(gone["_doc_id"]) & (F.xxhash64(docs["text"]) == gone["_h_text"])
    return docs.join(gone, same, "left").drop("_doc_id", "_h_text")


def _kept_text(docs: DataFrame) -> DataFrame:
    split = docs.withColumn("_lines", F.when(F.col("_removed").isNotNull(), F.split("text", "\n", -1)))
    kept = F.expr(
        "array_join(transform(array_except(sequence(0, size(_lines) - 1), _removed), i -> _lines[i]), '\\n')"
    )
    return split.withColumn("text", F.when(F.col("_removed").isNull(), F.col("text")).otherwise(kept)).drop("_lines")


def line_dedup(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_removed, text) of every row: its text without repeated lines.

    Lines are parted by line feeds; blank ones always stay. Of lines that are equal, or have ``min_chars``
    code points or more and differ by at most ``edits`` inserted, deleted or replaced characters, the
    earliest stays (by doc_id, nulls first, then text hash and line number).

    A null text has no lines and stays null; an empty one has one line. Rows that repeat both
    doc_id and text are treated alike; an empty table gives no rows; other columns are ignored.
    DataFrame functions only. Groups of equal lines cost one row in all joins but the last, which
    Spark splits where it is skewed; a document's own lines are the largest group collected.
    """
    rebuilt = _rebuilt(docs.select("doc_id", "text"), edits, min_chars)
    counted = rebuilt.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)))
    return _kept_text(counted).select(
        "doc_id",
        F.greatest(F.col("n_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(F.size(F.coalesce("_removed", F.array().cast("array<int>"))), F.lit(0)).cast("long").alias("n_removed"),
        "text",
    )


def strip_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``; ``n_chars``, if present, is counted anew.

    Rows that lose all their text stay, with an empty one.
    """
    # the rest of the row goes along as one value, so that no column of it can clash with those of the work
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    whole = docs.select("doc_id", "text", rest.alias("_row"))
    out = _kept_text(_rebuilt(whole, edits, min_chars))
    columns = []
    for c in docs.columns:
        value = F.col("text") if c == "text" else F.col("_row")[c]
        if c == "n_chars":
            value = F.when(F.col("_removed").isNotNull(), F.length("text").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return out.select(*columns)
