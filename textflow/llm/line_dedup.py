"""Line dedup by a deletion-neighbourhood join.

A line goes if an earlier one equals it or is within one edit (a character put
in, left out or changed) of it. Lines are compared after ASCII whitespace is
trimmed and squeezed and A-Z put in lower case; blank lines stay, and lines under
``MIN_NEAR`` characters only go for equal ones. Earlier means by ``doc_id``, then
by place.

The neighbourhood of a line is the line with any one character left out. Two
lines of one length within an edit share the variant that leaves out the changed
place; of two lines a character apart, the longer has a variant equal to the
shorter. All variants of all lines would be some hundred times the corpus, so
their number is cut first, without losing a pair: cut two such lines at the
middle, and one half is the same in both. Only lines that share a half (from the
start or from the end, of a length that follows from the line's) with another
distinct line emit variants, and only those that leave out a character of the
other half. Variants are joined as hashes and verified on the text.

With a larger bound (``edits``) a line also goes for an earlier one within two or
more edits, one for each ``MIN_NEAR`` characters of the shorter line up to the
bound. Leaving out two characters would make thousands of variants of a line, so
these are found by parts: of two lines within k edits, cut into k + 1 parts, one
part is the same in both, at most k characters away from its place. Up to ``CROWD``
lines that share a part are compared pair by pair. Larger groups go on to blocks
(two edits): two lines, cut into ``BLOCKS`` blocks, are equal in all but one block or
all but two with an edit in each. Lines that are equal outside a block meet by the
variants of that block with up to two characters left out; lines that are equal
outside two blocks by the variants with one left out of each. Variants are only made
of blocks that another line shares the outside of, and of the second kind only those
pairs of variants that are shared in either block. So the rows grow with the lines of
a group, not with their square. (Bounds of three or more compare pair by pair.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm.catalog import query
from textflow.llm.common import col, private_name, row_hash, written
from textflow.plans.catalog import table

MIN_NEAR = 20
#: Rows of ids or line numbers up to which a side is broadcast (some 20 bytes each);
#: a larger one is joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Lines that share a part which are compared pair by pair, at most; more go by blocks.
CROWD = 32
BLOCKS = 16


def normal(line: Column) -> Column:
    """A line as it is compared. Only lines with other whitespace than single
    spaces are squeezed, which is the costly part."""
    squeezed = F.when(line.rlike(r"[\x09-\x0D]|\x20\x20"), F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line)
    return F.lower(F.trim(squeezed))


def _small(side: DataFrame, rows: int) -> DataFrame:
    """``side`` (a written table) marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(side) if side.count() <= rows else side


def _halves(text: Column) -> Column:
    """``(side, key)`` of the halves that a line shares with a line within one edit.

    Of two lines the shorter with ``c`` characters, the first ``c / 2`` (rounded
    down, side 0) or the last ``c - c / 2`` (side 1) are equal; a line takes part
    with its own length and with one less."""
    n = F.char_length(text)

    def half(c: Column) -> Column:
        return F.floor(c / 2).cast("int")

    def key(side: int, size: Column, part: Column) -> Column:
        return F.struct(F.lit(side).alias("side"), F.xxhash64(F.lit(side), size, part).alias("key"))

    heads = [key(0, half(c), F.substring(text, F.lit(1), half(c))) for c in (n, n - 1)]
    tails = [key(1, c - half(c), F.substring(text, n - (c - half(c)) + 1, c - half(c))) for c in (n, n - 1)]
    return F.when(n >= MIN_NEAR, F.array_distinct(F.array(*heads, *tails)))


def _parts(text: Column, edits: int) -> Column:
    """Hashes of the parts that a line shares with a line within two to ``edits`` edits.

    The shorter line's length ``c`` tells the bound ``k`` and the parts. Of the equal
    part ``j`` there is one with at most ``j`` edits before it and ``k - j`` after it,
    so in a line ``longer`` characters longer it is moved by no more than these allow."""
    n = F.char_length(text)
    keys = []
    for k in range(2, edits + 1):
        for longer in range(k + 1):
            c = n - longer
            holds = (c >= k * MIN_NEAR) if k == edits else c.between(k * MIN_NEAR, (k + 1) * MIN_NEAR - 1)
            for j in range(k + 1):
                start, stop = (F.floor(c * i / (k + 1)).cast("int") for i in (j, j + 1))
                for moved in range(max(-j, longer - (k - j)), min(j, longer + k - j) + 1):
                    part = F.substring(text, start + moved + 1, stop - start)
                    keys.append(F.when(holds, F.xxhash64(F.lit(k), F.lit(j), c, part)))
    return F.array_distinct(F.array_compact(F.array(*keys)))


def _lines(docs: DataFrame, row: Column) -> DataFrame:
    """``(doc_id, row, pos, raw)``: the lines of every text, from 0."""
    text = F.coalesce(col(docs, "text").cast("string"), F.lit(""))
    return docs.select(col(docs, "doc_id").alias("doc_id"), row.alias("row"),
                       F.posexplode(F.split(text, "\n")).alias("pos", "raw"))


def _variants(candidates: DataFrame) -> DataFrame:
    """``(variant, place, id)``: hashes of a candidate line (place 0), and of the line
    without the character at ``place``, for the places beyond the half it shares."""
    n = F.char_length("line")
    shorter = F.floor((n - 1) / 2).cast("int")
    places = F.when(F.col("side") == 0, F.sequence(shorter + 1, n)).otherwise(
        F.sequence(F.lit(1), n - (n - 1 - shorter)))
    each = candidates.select("id", "line", F.explode(F.concat(F.array(F.lit(0)), places)).alias("place"))
    without = F.when(F.col("place") == 0, F.col("line")).otherwise(
        F.concat(F.substring("line", F.lit(1), F.col("place") - 1), F.substring("line", F.col("place") + 1, n)))
    return each.select(F.xxhash64(without).alias("variant"), "place", "id")


def _texts(docs: DataFrame, row: Column, wanted: DataFrame, keep: str, broadcast_rows: int) -> DataFrame:
    """``(id, keep, first, line)`` of the distinct lines ``wanted``, their texts read
    again at their first places."""
    wanted = written(wanted.select(
        "id", keep, "first", F.col("first.doc_id").alias("of"), F.col("first.row").alias("of_row"),
        F.col("first.pos").alias("of_pos")), "line-candidates")
    lines = _lines(docs, row)
    at = (lines["doc_id"].eqNullSafe(F.col("of")) & (lines["row"] == F.col("of_row")) & (lines["pos"] == F.col("of_pos")))
    return written(lines.join(_small(wanted, broadcast_rows), at).select(
        "id", keep, "first", normal(F.col("raw")).alias("line")).dropDuplicates(["id"]), "line-texts")


def _near(docs: DataFrame, row: Column, distinct: DataFrame, broadcast_rows: int) -> DataFrame:
    """Ids of the distinct lines that an earlier line is within one edit of."""
    keys = distinct.where("halves IS NOT NULL").select("id", F.xxhash64("id").alias("h"), F.explode("halves").alias("half")).select(
        "id", "h", "half.side", "half.key")
    shared = keys.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("key")
    sides = keys.join(shared, "key").groupBy("id").agg(F.collect_set("side").alias("sides"))  # at most two
    wanted = sides.join(distinct.select("id", "first"), "id")
    candidates = _texts(docs, row, wanted, "sides", broadcast_rows)
    variants = written(_variants(candidates.select("id", "line", F.explode("sides").alias("side"))), "line-variants")
    # a variant that two lines have; the rest, which is nearly all, ends here
    common = variants.groupBy("variant").agg(
        F.min(F.xxhash64("id")).alias("lo"), F.max(F.xxhash64("id")).alias("hi")).where("lo <> hi").select("variant")
    lookup = candidates.select("id", "first")
    met = written(variants.join(common, "variant").distinct().join(lookup, "id"), "line-met")
    # the earliest line of each variant and place, and of each variant: lines with the
    # same place left out differ in it alone, a whole line and a variant by one character
    earliest = F.min(F.struct("first", "id"))
    by_place = met.groupBy("variant", "place").agg(earliest.alias("best"))
    whole = by_place.groupBy("variant").agg(
        F.min("best").alias("best_any"), F.min(F.when(F.col("place") == 0, F.col("best"))).alias("best_whole"))
    beside = met.join(by_place, ["variant", "place"]).join(whole, "variant")
    best = F.when(F.col("place") == 0, F.col("best_any")).otherwise(F.least("best", "best_whole"))
    pairs = (beside.select("id", "first", best.alias("best")).where(F.col("best.first") < F.col("first"))
             .select("id", F.col("best.id").alias("other")).distinct())
    texts = candidates.select("id", "line")
    others = candidates.select(F.col("id").alias("other"), F.col("line").alias("other_line"))
    verified = pairs.join(texts, "id").join(others, "other").where(
        F.levenshtein("line", "other_line", 1).between(0, 1))
    return verified.select("id").distinct()


def _outsides(lines: DataFrame) -> DataFrame:
    """``(no, d, s, two, outside, inner, inner2)``: each line's ways to lie within two
    edits of another, by blocks.

    Of two such lines let the shorter have ``c`` characters, its blocks cut at
    ``c * i / BLOCKS``, and the longer ``d`` more. Both edits are in one block, ``d``
    characters longer in the other line; or one each in two, ``s`` and ``d - s`` longer
    (-1 to 1). ``outside`` is a hash of all else; a line takes part as the shorter one
    (``d`` and ``s`` 0) and, with what it may be longer by, as the other."""
    ways = lines.select("no", "line", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("d"))
    ways = ways.withColumn("c", F.char_length("line") - F.col("d")).where(F.col("c") >= 2 * MIN_NEAR)
    ways = ways.select("*", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("i"))
    later = F.when(F.col("i") < BLOCKS - 1, F.sequence(F.col("i") + 1, F.lit(BLOCKS - 1))).otherwise(F.array().cast("array<int>"))
    ways = ways.select("*", F.explode(F.concat(F.array(F.lit(-1)), later)).alias("j"))
    shifts = F.when(F.col("j") < 0, F.array("d")).otherwise(F.sequence(F.greatest(F.lit(-1), F.col("d") - 1), F.least(F.lit(1), F.col("d") + 1)))
    ways = ways.select("*", F.explode(shifts).alias("s"))

    def bound(block: Column) -> Column:
        return F.floor(F.col("c") * block / BLOCKS).cast("int")

    two, n = F.col("j") >= 0, F.char_length("line")
    start, stop = bound(F.col("i")), bound(F.col("i") + 1) + F.col("s")
    start2, stop2 = bound(F.col("j")) + F.col("s"), bound(F.col("j") + 1) + F.col("d")

    def part(a: Column, b: Column) -> Column:
        return F.substring("line", a + 1, b - a)

    rest = F.when(two, F.xxhash64(part(stop, start2), part(stop2, n))).otherwise(F.xxhash64(part(stop, n)))
    return ways.select(
        "no", "d", "s", two.alias("two"), F.xxhash64("c", "i", "j", part(F.lit(0), start), rest).alias("outside"),
        part(start, stop).alias("inner"), F.when(two, part(start2, stop2)).alias("inner2"))


def _without(text: str, place: Column) -> Column:
    """The text without the character at ``place`` (0: the whole text)."""
    return F.when(place == 0, F.col(text)).otherwise(
        F.concat(F.substring(text, F.lit(1), place - 1), F.substring(F.col(text), place + 1, F.char_length(text))))


def _shared(rows: DataFrame, keys: list[str], of: str, broadcast_rows: int) -> DataFrame:
    """The values of ``keys`` that two different ``of`` have, and the rows with them (``n``).
    Broadcast if they are few; else to be joined by a shuffle, as Spark takes what a few
    lines are exploded to for as small as they are."""
    counted = rows.groupBy(*keys).agg(F.min(of).alias("lo"), F.max(of).alias("hi"), F.count(F.lit(1)).alias("n"))
    found = written(counted.where("lo <> hi").drop("lo", "hi"), "line-shared")
    return F.broadcast(found) if found.count() <= broadcast_rows else found.hint("merge")


def _earlier_pairs(rows: DataFrame, key: str) -> DataFrame:
    """``(id, other)`` of the lines with one key of which ``other`` is the earlier."""
    others = rows.select(key, F.col("id").alias("other"), F.col("first").alias("other_first"))
    return rows.select(key, "id", "first").join(others, key).where(F.col("other_first") < F.col("first")).select("id", "other")


def _one_block(met: DataFrame, lines: DataFrame, broadcast_rows: int) -> DataFrame:
    """``(id, other)`` for lines that are equal outside one block."""
    one = met.where("NOT two")
    few = written(one.where(F.col("n") <= CROWD).join(lines, "no").select("id", "first", "outside"), "block-few")
    places = one.where(F.col("n") > CROWD).select("no", "outside", "inner", F.explode(F.sequence(F.lit(0), F.char_length("inner"))).alias("p"))
    before = F.when(F.col("p") > 1, F.sequence(F.lit(0), F.col("p") - 1)).otherwise(F.array(F.lit(0)))
    cut = places.select("no", "outside", _without("inner", F.col("p")).alias("once"), F.explode(before).alias("q"))
    variants = cut.select("no", F.xxhash64("outside", _without("once", F.col("q"))).alias("variant"))
    common = variants.join(_shared(variants, ["variant"], "no", broadcast_rows).select("variant"), "variant").distinct()
    many = written(common.join(lines, "no").select("id", "first", "variant"), "block-variants-met")
    return _earlier_pairs(few, "outside").union(_earlier_pairs(many, "variant"))


def _tokens(rows: DataFrame, inner: str, longer: Column) -> DataFrame:
    """``rows`` with ``(how, token, of)``: what a block has in common with one within an edit.

    ``how`` is what the other line's block is longer by. Blocks of one length (0) agree in
    the place that is left out and in the rest; otherwise the longer one without a
    character is the shorter one as it is. ``longer`` tells which a row's block is; the
    shorter line of a pair (``x``) stands ready for all three. ``of`` tells whose the token
    is, so that another's can be told from it: that of an equal block the line's, any other
    the content's (lines with one content share its variants, which says nothing more)."""
    p, x = F.col("p"), F.col("x")
    placed = rows.select("*", F.explode(F.sequence(F.lit(0), F.char_length(inner))).alias("p"))
    placed = placed.withColumn("cut", _without(inner, p))

    content = F.xxhash64(inner)

    def token(how: int, when: Column, *parts: Column) -> Column:
        of = F.when(p == 0, F.col("no")).otherwise(content) if how == 0 else content
        return F.when(when, F.struct(F.lit(how).alias("how"), F.xxhash64(F.lit(how), *parts).alias("token"), of.alias("of")))

    each = F.array(
        token(0, x | (longer == 0), p, F.col("cut")),
        token(1, F.when(x, p == 0).otherwise((longer == 1) & (p > 0)), F.col("cut")),
        token(-1, F.when(x, p > 0).otherwise((longer == -1) & (p == 0)), F.col("cut")))
    return placed.select("no", "x", "d", "s", "outside", F.inline(F.array_compact(each))).distinct()


def _two_blocks(met: DataFrame, lines: DataFrame, broadcast_rows: int) -> DataFrame:
    """``(id, other)`` for lines that are equal outside two blocks with an edit in each;
    ``other`` is the earliest one, for each way in which the blocks agree."""
    two = met.where("two").drop("n").withColumn("x", (F.col("d") == 0) & (F.col("s") == 0))
    sides = []
    for name, inner, longer in (("1", "inner", F.col("s")), ("2", "inner2", F.col("d") - F.col("s"))):
        tokens = _tokens(two, inner, longer)
        common = _shared(tokens, ["outside", "token"], "of", broadcast_rows).drop("n")
        sides.append(written(tokens.drop("of").join(common, ["outside", "token"]), "block-tokens").withColumnsRenamed(
            {"how": "how" + name, "token": "token" + name}))
    left, right = sides
    # of a line's tokens in the one block and the other, those that may go together
    way = ["no", "x", "d", "s", "outside"]
    allowed = F.when(F.col("x"), (F.col("how1") + F.col("how2")).between(0, 2)).otherwise(
        (F.col("how1") == F.col("s")) & (F.col("how2") == F.col("d") - F.col("s")))
    both = left.join(right.hint("merge"), way).where(allowed).select("no", "x", "outside", "how1", "token1", "how2", "token2")
    group = F.xxhash64("outside", "how1", "token1", "how2", "token2")
    equal = (F.col("how1") == 0) & (F.col("how2") == 0)      # then either line is the shorter one
    both = both.select("no", "x", equal.alias("equal"), group.alias("agreed"))
    both = both.join(_shared(both, ["agreed"], "no", broadcast_rows).drop("n"), "agreed")
    both = written(both.join(lines, "no").select("id", "first", "x", "equal", "agreed"), "block-pairs")
    earliest = F.struct("first", "id")
    best = both.groupBy("agreed").agg(F.min(F.when(F.col("x"), earliest)).alias("x_best"),
                                      F.min(F.when(~F.col("x") | F.col("equal"), earliest)).alias("y_best"))
    other = F.when(F.col("x"), F.col("y_best")).otherwise(F.col("x_best"))
    found = both.join(best, "agreed").select("id", "first", other.alias("other"))
    return found.where(F.col("other.first") < F.col("first")).select("id", F.col("other.id").alias("other"))


def _further(docs: DataFrame, row: Column, distinct: DataFrame, near: DataFrame, broadcast_rows: int, edits: int) -> DataFrame:
    """Ids of the distinct lines, those of ``near`` aside, that an earlier line is within
    ``edits`` edits of."""
    keys = distinct.select("id", F.xxhash64("id").alias("h"), F.explode("parts").alias("key"))
    shared = keys.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("key")
    wanted = keys.join(shared, "key").groupBy("id").agg(F.collect_set("key").alias("keys"))  # as many as parts
    candidates = _texts(docs, row, wanted.join(distinct.select("id", "first"), "id"), "keys", broadcast_rows)
    # written, so that both sides are plain shuffles and AQE splits those of crowded parts
    at = written(candidates.select("id", "first", F.explode("keys").alias("key")), "line-parts")
    crowded = at.groupBy("key").count().where(F.col("count") > CROWD).select("key")
    if edits == 2 and not (crowded := written(crowded, "crowded-parts")).isEmpty():
        lines = at.join(crowded, "key", "left_semi").select("id").distinct().join(candidates.select("id", "first", "line"), "id")
        lines = written(lines.withColumn("no", F.monotonically_increasing_id()), "crowded-lines")   # a short name for each
        ways, names = _outsides(lines), lines.select("no", "id", "first")
        met = written(ways.join(_shared(ways, ["outside"], "no", broadcast_rows), "outside"), "block-ways")
        pairs = _earlier_pairs(at.join(crowded, "key", "left_anti"), "key").union(
            _one_block(met, names, broadcast_rows)).union(_two_blocks(met, names, broadcast_rows))
    else:
        pairs = _earlier_pairs(at, "key")
    pairs = pairs.join(_small(near, broadcast_rows), "id", "left_anti").distinct()
    others = candidates.select(F.col("id").alias("other"), F.col("line").alias("other_line"))
    bound = F.least(F.lit(edits), F.floor(F.least(F.char_length("line"), F.char_length("other_line")) / MIN_NEAR))
    distance = F.levenshtein("line", "other_line", edits)
    return pairs.join(candidates.select("id", "line"), "id").join(others, "other").where(
        (distance >= 0) & (distance <= bound)).select("id").distinct()


def removed_lines(docs: DataFrame, row: Column, broadcast_rows: int = BROADCAST_ROWS, edits: int = 1) -> DataFrame:
    """``(doc_id, row, removed)``: for each document that loses lines their numbers."""
    if edits < 1:
        raise ValueError("edits must be 1 or more")
    # blank lines are told by the raw line: a filter on the normal form would compute it twice
    lines = _lines(docs, row).where(F.col("raw").rlike(r"[^\x20\x09-\x0D]")).select(
        "doc_id", "row", "pos", normal(F.col("raw")).alias("line"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "pos")
    shares = [_halves(F.col("line")).alias("halves")] + ([_parts(F.col("line"), edits).alias("parts")] if edits > 1 else [])
    found = written(lines.select(F.unhex(F.md5("line")).alias("id"), place.alias("place"), *shares), "lines")
    firsts = [F.first(c).alias(c) for c in found.columns[2:]]
    distinct = written(found.groupBy("id").agg(F.min("place").alias("first"), F.max("place").alias("last"), *firsts), "distinct-lines")
    near = _near(docs, row, distinct, broadcast_rows)
    if edits > 1:
        near = written(near, "near-lines")
        near = near.union(_further(docs, row, distinct, near, broadcast_rows, edits))
    near = near.select("id", F.lit(True).alias("near"))
    # written, so that both sides of the next join are plain shuffles: AQE splits those of hot lines
    loses = written(distinct.select("id", "first", "last").join(near, "id", "left").where("near OR first <> last").select(
        "id", "first", F.coalesce("near", F.lit(False)).alias("near")), "lines-lost")
    gone = found.select("id", "place").join(loses, "id").where("near OR place <> first")
    return gone.select("place.doc_id", "place.row", "place.pos").groupBy("doc_id", "row").agg(
        F.collect_set("pos").alias("removed"))


def dedup_lines(docs: DataFrame, n_lines: str | None = None, n_removed: str | None = None,
                broadcast_rows: int = BROADCAST_ROWS, edits: int = 1) -> DataFrame:
    """``docs`` with later copies and near copies of lines taken out of ``text``;
    other columns as they are, and the line counts if named. Near is within one
    edit for each ``MIN_NEAR`` characters of the shorter line, up to ``edits``.

    Of equal ``doc_id`` the row with the smaller row hash is the earlier, a null
    ``doc_id`` is later than all; wholly equal rows count as one document and
    get the same text. Null and empty texts stay, as do blank lines; an empty
    table stays empty."""
    row = private_name(docs, "row")
    gone = private_name(docs, "removed")
    hashed = row_hash(docs)
    removed = written(removed_lines(docs, hashed, broadcast_rows, edits), "removed-lines")
    total = removed.agg(F.sum(F.size("removed"))).first()[0] or 0
    keyed = docs.withColumn(row, hashed)
    side = removed.select(F.col("doc_id").alias("of"), F.col("row").alias("of_row"), F.col("removed").alias(gone))
    at = col(keyed, "doc_id").eqNullSafe(F.col("of")) & (keyed[row] == F.col("of_row"))
    joined = keyed.join(F.broadcast(side) if total <= broadcast_rows else side, at, "left")
    lines = F.split(col(joined, "text").cast("string"), "\n")
    # in a struct, so that the text is split once; the places left are found by hashing
    parted = F.array(F.struct(lines.alias("lines"), F.col(gone).alias("gone")))
    kept = F.transform(parted, lambda d: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(d["lines"]) - 1), d["gone"]), lambda k: F.get(d["lines"], k)), "\n"))[0]
    text = F.when(F.col(gone).isNull(), col(joined, "text").cast("string")).otherwise(kept)
    counts = []
    if n_lines:
        counts.append(F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(n_lines))
    if n_removed:
        counts.append(F.when(F.col(gone).isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long").alias(n_removed))
    return joined.select(*[text.alias(c) if c == "text" else col(joined, c).alias(c) for c in docs.columns], *counts)


def drop_emptied(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS, edits: int = 1) -> DataFrame:
    """``dedup_lines``, without the documents that lost every line that was not
    blank; documents that had none before stay."""
    count = private_name(docs, "removed")
    deduped = dedup_lines(docs, n_removed=count, broadcast_rows=broadcast_rows, edits=edits)
    blank = F.trim(F.regexp_replace(col(deduped, "text"), r"[\x20\x09-\x0D]+", " ")) == ""
    return deduped.where((F.col(count) == 0) | ~blank).drop(count)


_SQL_NORMAL = "lower(trim(regexp_replace(raw, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' '))"
OP1_SQL = f"""
WITH raws AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
                     generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, pos, raw, {_SQL_NORMAL} AS line FROM raws),
firsts AS (SELECT line, min(row(doc_id, pos)) AS first FROM lines WHERE line <> '' GROUP BY line),
cut AS (SELECT line, first, p, substr(line, 1, p - 1) || substr(line, p + 1) AS variant
        FROM (SELECT *, unnest(range(1, length(line) + 1)) AS p FROM firsts WHERE length(line) >= {MIN_NEAR})),
near AS (SELECT line FROM (SELECT line, first, min(first) OVER (PARTITION BY variant, p) AS best FROM cut) WHERE best < first
         UNION SELECT c.line FROM cut c JOIN firsts f ON f.line = c.variant AND length(f.line) >= {MIN_NEAR} WHERE f.first < c.first
         UNION SELECT f.line FROM cut c JOIN firsts f ON f.line = c.variant AND length(f.line) >= {MIN_NEAR} WHERE c.first < f.first),
judged AS (SELECT l.*, l.line <> '' AND (row(l.doc_id, l.pos) <> f.first OR n.line IS NOT NULL) AS gone
           FROM lines l LEFT JOIN firsts f ON l.line = f.line LEFT JOIN near n ON n.line = l.line),
joined AS (SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
                  count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed FROM judged GROUP BY doc_id)
SELECT d.doc_id, j.text, CAST(coalesce(j.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(j.n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN joined j ON d.doc_id = j.doc_id
"""


@query("op1_line_dedup", OP1_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, "n_lines", "n_removed")
