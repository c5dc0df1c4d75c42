"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line, or a clause of it up to punctuation and a blank. A text is the
set of its paragraphs' digests: 48 bits, and 16 that check them. A sketch has
three rows of eight cells. Each digest falls into one cell of each row, and a
cell holds how many digests it has and their exclusive or.

Two sketches are subtracted cell by cell. Digests that both have cancel out; a
cell that is left with a single one gives it up, which may lay open others
(peeling). When all cells end up empty, the digests in which the two texts
differ are known, and with them the likeness: common paragraphs by all.

Where peeling fails the pair is tried again on larger sketches: digests are dealt
by a salted hash to parts that have a sketch of twelve cells each, as many as
the failed sketch lets expect, and parts that fail again are dealt anew. A part
has a few digests by then, so that the work grows with the length of the texts.
Digests that no sketch has told apart after ``TRIES`` deals are compared as they
are; for two of them to come there takes twelve deals into the same part.

Everything is done with column functions. Texts are shuffled once, by id and
text; a text that edits the one before it in the order of ids sends that one its
head and its digests. The order of ids is a range partitioning of ids and hashes
alone: windows run within its parts, and the first row of each part is all that
one task sees of the others.

Defined results: a null text is empty, has no paragraph, an empty sketch, and
likeness 1 to other empty texts and 0 to all others. Rows with one id are in the
order of their texts' hashes. Rows that repeat id and text are one document, and
each of them gets its result. Null ids come last. A table of one document is
edited by itself. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimgauge.sources.scratch import stage

#: a sketch has three rows, whose cells are numbered by bits of a digest; sketches of parts are smaller
ROWS, BITS, PART_BITS = 3, 3, 2
#: deals of the digests that no smaller sketch could tell
TRIES = 12
PARAGRAPH_BREAK = r"[.,;:!?][ \t]+|\n+"

# Digests have 16 bits of check below; rows take the bits above them.
_CHECK = "(xxhash64(shiftright({0}, 16)) & 65535L)"
_NONE = "cast(array() as array<bigint>)"
_NO_PARTS = "cast(array() as array<array<struct<k: bigint, s: bigint, q: bigint>>>)"


def _cells(bits: int) -> str:
    """Where the cells of a sketch look: shift and value of a digest's bits."""
    places = [(16 + bits * row, place) for row in range(ROWS) for place in range(1 << bits)]
    return "array(" + ", ".join(f"named_struct('s', {shift}, 'p', {place}L)" for shift, place in places) + ")"


def digests(text: Column) -> Column:
    """Distinct paragraph digests of a text that is not null."""
    paragraphs = F.filter(F.split(text, PARAGRAPH_BREAK), lambda p: F.length(p) > 0)
    high = F.array_distinct(F.transform(paragraphs, lambda p: F.shiftright(F.xxhash64(p), 16)))
    return F.transform(high, lambda h: F.shiftleft(h, 16).bitwiseOR(F.xxhash64(h).bitwiseAND(F.lit(65535).cast("long"))))


def sketch(of: str) -> str:
    """Cells (n, x) of the array of digests that the SQL expression ``of`` names."""
    return f"""transform({_cells(BITS)}, c -> aggregate(
        filter({of}, k -> (shiftright(k, c.s) & {(1 << BITS) - 1}) = c.p), named_struct('n', 0L, 'x', 0L),
        (t, k) -> named_struct('n', t.n + 1L, 'x', t.x ^ k)))"""


def _subtracted(first: str, second: str) -> str:
    return f"zip_with({first}, {second}, (p, q) -> named_struct('n', p.n - q.n, 'x', p.x ^ q.x))"


def _part_difference(part: str) -> str:
    """The difference of the sketches of both sides of a part, summed over its signed digests."""
    return f"""transform({_cells(PART_BITS)}, c -> aggregate(
        filter({part}, t -> (shiftright(t.k, c.s) & {(1 << PART_BITS) - 1}) = c.p), named_struct('n', 0L, 'x', 0L),
        (d, t) -> named_struct('n', d.n + t.s, 'x', d.x ^ t.k)))"""


def written(cells: str) -> str:
    """A sketch as text: cells as count:digests in hexadecimal, joined by points."""
    return f"array_join(transform({cells}, c -> concat(hex(c.n), ':', hex(c.x))), '.')"


def _let(value: str, name: str, then: str) -> str:
    return f"get(transform(array({value}), {name} -> {then}), 0)"


def _peeled(cells: str, bits: int) -> str:
    """What a difference of sketches holds: ok, l (only in the first), r (only in the second)."""
    width, mask = 1 << bits, (1 << bits) - 1
    # the first cell with a single digest gives it up, and it leaves the cells that it falls into; a cell of several
    # that passes the check by chance does not come out empty in every row
    single = f"abs(c.n) = 1L and (c.x & 65535L) = {_CHECK.format('c.x')}"
    nothing = "cast(null as struct<n: bigint, x: bigint>)"
    alone = f"aggregate(s.cells, {nothing}, (u, c) -> if(u is not null, u, if({single}, c, u)))"
    cells_of = [f"{width * row} + (shiftright(u.x, {16 + bits * row}) & {mask})" for row in range(ROWS)]
    places = " | ".join(f"shiftleft(1, cast({cell} as int))" for cell in cells_of)
    touched = "(shiftright(w, i) & 1) = 1"
    removed = f"transform(s.cells, (c, i) -> if({touched}, named_struct('n', c.n - u.n, 'x', c.x ^ u.x), c))"
    after = f"""named_struct('cells', {_let(places, "w", removed)},
        'l', if(u.n = 1L, array_append(s.l, u.x), s.l), 'r', if(u.n = 1L, s.r, array_append(s.r, u.x)), 'done', false)"""
    stuck = "named_struct('cells', s.cells, 'l', s.l, 'r', s.r, 'done', true)"
    step = _let(alone, "u", f"if(u is null, {stuck}, {after})")
    start = f"named_struct('cells', {cells}, 'l', {_NONE}, 'r', {_NONE}, 'done', false)"
    rounds = f"aggregate(sequence(1, {ROWS * width + 1}), {start}, (s, round) -> if(s.done, s, {step}))"
    return _let(rounds, "w", "named_struct('ok', forall(w.cells, c -> c.n = 0L and c.x = 0L), 'l', w.l, 'r', w.r)")


def _dealt(signed: str, salt: str, parts: str) -> str:
    """Signed digests in 2 to 64 parts, by a hash that ``salt`` changes."""
    part = f"pmod(xxhash64(t.k, {salt}), parts)"
    numbered = f"transform({signed}, t -> named_struct('k', t.k, 's', t.s, 'q', {part}))"
    # by eights first, so that a part is not looked for among all digests
    of_eight = _let("filter(f, t -> t.q div 8 = g)", "e", "transform(sequence(8 * g, least(8 * g + 7, parts - 1L)), q -> filter(e, t -> t.q = q))")
    deal = _let(numbered, "f", f"flatten(transform(sequence(0L, (parts - 1L) div 8), g -> {of_eight}))")
    return _let(f"greatest(2L, least(64L, {parts}))", "parts", deal)


def differences(a: str, b: str, cells_a: str, cells_b: str) -> Column:
    """Struct of the digests only in ``a`` (l) and only in ``b`` (r), recovered from sketches.

    All four name columns: digests and their sketches. Larger sketches are made where those do not suffice.
    """
    # counts of differing digests in a cell add up like a random walk, so that their squares tell how many there are
    excess = f"cast(size({a}) - size({b}) as bigint)"
    squares = "aggregate(g, 0L, (t, c) -> t + c.n * c.n)"
    differing = f"({squares} div {ROWS} - {excess} * {excess} div {1 << BITS})"
    signed = ", ".join(f"transform({x}, k -> named_struct('k', k, 's', {sign}L, 'q', 0L))" for x, sign in ((a, 1), (b, -1)))
    start = _let(
        _subtracted(cells_a, cells_b),
        "g",
        _let(
            _peeled("g", BITS),
            "y",
            f"""named_struct('l', if(y.ok, y.l, {_NONE}), 'r', if(y.ok, y.r, {_NONE}),
                'open', if(y.ok, {_NO_PARTS}, {_dealt(f"concat({signed})", "0", f"{differing} div 3")}))""",
        ),
    )
    tried = _let(_peeled(_part_difference("d"), PART_BITS), "y", "named_struct('ok', y.ok, 'l', y.l, 'r', y.r, 'd', d)")
    results = f"transform(z.open, d -> {tried})"
    again = _dealt("h.d", "try", "cast(size(h.d) div 4 as bigint)")
    after = f"""named_struct(
        'l', concat(z.l, flatten(transform(filter(g, h -> h.ok), h -> h.l))),
        'r', concat(z.r, flatten(transform(filter(g, h -> h.ok), h -> h.r))),
        'open', flatten(transform(filter(g, h -> not h.ok), h -> {again})))"""
    loop = f"aggregate(sequence(1, {TRIES}), {start}, (z, try) -> if(size(z.open) = 0, z, {_let(results, 'g', after)}))"
    side = {x: f"transform(filter(d, t -> t.s = {sign}L), t -> t.k)" for x, sign in (("l", 1), ("r", -1))}
    rest = [f"flatten(transform(v.open, d -> array_except({side[x]}, {side[y]})))" for x, y in ("lr", "rl")]
    return F.expr(_let(loop, "v", f"named_struct('l', concat(v.l, {rest[0]}), 'r', concat(v.r, {rest[1]}))"))


def likeness(n: str, differing: str) -> Column:
    """Common digests by all digests, of a set of ``n`` and what differs from it; 1 if there is none."""
    share = f"cast({n} - size({differing}.l) as double) / nullif({n} + size({differing}.r), 0)"
    return F.expr(f"coalesce({share}, 1D)")


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per id and text: kn, kid and tie name it, row has id and text, copies counts the rows."""
    base = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    return base.select(
        F.col("id").isNull().alias("kn"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("kid"),
        F.xxhash64("body").alias("tie"), "id", "body",
    )


def following(named: DataFrame) -> DataFrame:
    """Every document's key and length, with the key of the next one in the order of ids."""
    key = ["kn", "kid", "tie"]
    slim = named.groupBy(*key).agg(F.first("id").alias("id"), F.max(F.length("body")).alias("n"))
    order = ["kn", "id", "tie"]
    ranges = slim.repartitionByRange(*order).select("*", F.spark_partition_id().alias("part"))
    ranges = stage(ranges, "document-order")
    this = F.struct(*key)
    inside = ranges.withColumn("after", F.lead(this).over(Window.partitionBy("part").orderBy(*order)))
    # as many rows as the order has parts
    firsts = ranges.groupBy("part").agg(F.min(F.struct("kn", "id", "tie", "kid")).alias("row"))
    firsts = firsts.select("part", F.struct(*(F.col(f"row.{c}").alias(c) for c in key)).alias("head"))
    parts = Window.orderBy("part")
    borders = firsts.select(
        "part", F.coalesce(F.lead("head").over(parts), F.first("head").over(parts.rowsBetween(Window.unboundedPreceding, 0))).alias("border")
    )
    joined = inside.join(F.broadcast(borders), "part").withColumn("next", F.coalesce("after", "border"))
    return joined.select(*key, "n", *(F.col(f"next.{c}").alias(f"next_{c}") for c in key))


def edited_versions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, copies, body, edited text, and digests of body (a), edited text (e) and next document (b).

    The edited text has its last quarter replaced by as many characters of the next document's head, or all of it.
    """
    names = ["kn", "kid", "tie"]
    named = _documents(docs, key, text)
    whole = named.groupBy(*names).agg(F.first(F.struct("id", "body")).alias("row"), F.count("*").alias("copies"))
    # both uses of ``whole`` need the same columns, so that texts are shuffled once
    before = following(named).select(
        *(F.col(f"next_{c}").alias(c) for c in names), *(F.col(c).alias(f"to_{c}") for c in names), F.floor(F.col("n") / 4).cast("int").alias("need")
    )
    heads = (
        whole.where("copies > 0")
        .join(before, names)
        .select(
            *(F.col(f"to_{c}").alias(c) for c in names),
            F.expr("substring(row.body, 1, need)").alias("head"),
            digests(F.col("row.body")).alias("b"),
        )
    )
    both = whole.where("copies > 0").join(heads, names)
    body = F.col("row.body")
    return both.select(
        F.col("row.id").alias(key), "copies", body.alias("body"), "b", digests(body).alias("a"),
        F.expr("concat(substring(row.body, 1, length(row.body) - cast(floor(length(row.body) / 4) as int)), head)").alias("edited"),
    )


def version_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; one row per row."""
    rows = edited_versions(docs, key, text).select(
        F.col(f"`{key}`"), "copies", F.length("body").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "a", "b", digests(F.col("edited")).alias("e"),
    )
    rows = rows.select("*", *(F.expr(sketch(c)).alias(f"cells_{c}") for c in "aeb"))
    # a generator keeps what is above from being computed again for each use
    kept = [key, "copies", "n_chars", "edited_sha256", "a", "e", "b", "cells_a", "cells_e", "cells_b"]
    rows = rows.select(F.inline(F.array(F.struct(*(F.col(f"`{c}`") for c in kept)))))
    rows = rows.select(
        F.col(f"`{key}`"), "copies", "n_chars", "edited_sha256", F.size("a").alias("n"),
        F.expr(written("cells_a")).alias("fingerprint"), F.expr(written("cells_e")).alias("edited_fingerprint"),
        differences("a", "e", "cells_a", "cells_e").alias("to_edited"), differences("a", "b", "cells_a", "cells_b").alias("to_next"),
    )
    rows = rows.select(
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"), F.col(f"`{key}`"), "n_chars", "edited_sha256",
        "fingerprint", "edited_fingerprint", likeness("n", "to_edited").alias("near_edited"), likeness("n", "to_next").alias("near_next"),
    )
    return rows.drop("copy")
