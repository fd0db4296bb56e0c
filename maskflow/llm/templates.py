"""Line dedup by a log-template tree, in DataFrame functions alone.

Tokens with a digit are variable fields; a line with its fields masked is a form. Lines of
one form always belong together. Forms meet in leaves of the tree: by their number of tokens
and their leading ones. In order of first document and text a form joins the first template
of its leaf that it is alike enough to, or founds one. A leaf has as many templates as that
takes: they are founded in batches, of which none changes what the batches give together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskflow.llm.common import null_key, stored

# Leading tokens that a path through the tree is made of, below the token count.
DEPTH = 3
# Share of the places, but for those variable in both, that two forms must have in common.
SIMILAR = 0.8
FIELD = "<*>"
# Earliest forms of a leaf among which templates are founded in the first round; every
# round takes four times as many as that before, up to the most a row is to hold. They
# bound rows, not templates: rounds go on until no form is left.
FOUNDERS = 16
MOST_FOUNDERS = 1024
# Characters of forms beyond the first 16 that a row is to hold.
BATCH_CHARS = 1 << 20
# Tokens with a digit, found from their first character on, so that a long token is
# read once.
NUMBERED = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"
# A null doc_id is one document, after all others.
LAST = (1 << 63) - 1
# Rows of fixed size, about 50 bytes, up to which leaves and decisions are broadcast.
BROADCAST_ROWS = 500_000
SALTS = 16


def masked(line: Column) -> Column:
    """A line with every token that holds a digit as a variable field."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, NUMBERED, FIELD)).otherwise(line)


def lines_of(docs: DataFrame, depth: int) -> DataFrame:
    """(key, body, doc, place, form, n, leaf, f1, f2) for every line that is not blank.

    ``key`` and ``body`` name the row by its doc_id and a hash of its text; ``n`` is the
    number of tokens, ``leaf`` a hash of it and the leading ones, ``f1`` and ``f2`` are two
    hashes that together stand for the form.
    """
    rows = docs.select(
        null_key(F.col("doc_id")).alias("key"),
        F.xxhash64("text").alias("body"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"),
        F.posexplode(F.split("text", "\n")).alias("place", "line"),
    )
    rows = rows.where(F.trim("line") != "").withColumn("form", masked(F.col("line"))).drop("line")
    spaces = F.length("form") - F.length(F.replace("form", F.lit(" "), F.lit("")))
    return rows.withColumn("n", spaces + 1).withColumns(
        {
            "leaf": F.xxhash64("n", F.substring_index("form", " ", depth)),
            "f1": F.xxhash64("form"),
            "f2": F.xxhash64(F.lit(1), "form"),
        }
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of the places at which two forms, as arrays of one length, have the same word,
    places that are variable in both left out; 1 if all are."""
    places = F.zip_with(a, b, lambda x, y: F.when(x != y, 0).when(x == FIELD, None).otherwise(1))
    counted = F.filter(places, lambda x: x.isNotNull())
    alike = F.aggregate(counted, F.lit(0), lambda total, x: total + x)
    return F.when(F.size(counted) == 0, F.lit(1.0)).otherwise(alike / F.size(counted))


def met_by(rows: DataFrame, small: DataFrame, keys: list[str], spread: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``small``, a table of few rows a key: every row of it is copied to
    16 salts, so that a hot key is spread by ``spread``."""
    salted = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = rows.withColumn("salt", F.pmod(spread, F.lit(SALTS)).cast("int"))
    return own.join(salted, [*keys, "salt"], how).drop("salt")


def earliest(forms: DataFrame, most: int) -> DataFrame:
    """(leaf, n, early, whole): the earliest ``most`` forms of every leaf, by first document
    and then text, as (first, form, f1, f2, last, words), fewer if they are long; ``whole``
    says whether these are all."""
    order = Window.partitionBy("leaf", "n").orderBy("first", "form")
    early = forms.withColumn("at", F.row_number().over(order)).where(F.col("at") <= most + 1)
    chars = F.sum(F.length("form").cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    fits = (F.col("at") <= min(most, FOUNDERS)) | ((F.col("at") <= most) & (F.col("chars") <= BATCH_CHARS))
    early = early.withColumn("chars", chars).withColumn("fits", fits)
    member = F.struct("first", "form", "f1", "f2", "last", F.split("form", " ").alias("words"))
    return early.groupBy("leaf", "n").agg(
        F.array_sort(F.collect_list(F.when(F.col("fits"), member))).alias("early"), F.every("fits").alias("whole")
    )


def founders_of(early: Column, similar: float) -> Column:
    """Of sorted forms those unlike every founder before them, as (first, words)."""
    own = F.transform(early, lambda e: F.struct(e["first"].alias("first"), e["words"].alias("words")))
    return F.aggregate(
        own, F.slice(own, 1, 0),
        lambda found, e: F.when(
            F.exists(found, lambda f: likeness(f["words"], e["words"]) >= similar), found
        ).otherwise(F.concat(found, F.array(e))),
    )


def keeper_among(founders: Column, words: Column, similar: float) -> Column:
    """First document of the first founder a form is alike to, or null."""
    return F.get(F.filter(founders, lambda f: likeness(words, f["words"]) >= similar), F.lit(0))["first"]


def blocks(words: Column, n: Column, depth: int, similar: float) -> Column:
    """Hashes of the runs that the places below the leading tokens are cut into: one run more
    than places in which forms alike enough can differ, so that such forms of a leaf have a
    run in common. Runs are empty, and in common, where there are more of them than places."""
    runs = F.floor(n * F.lit(1 - similar) + 1e-9).cast("int") + 1
    below = F.greatest(n - depth, F.lit(0))

    def run(k: Column) -> Column:
        start, end = (F.floor(at * below / runs).cast("int") for at in (k, k + 1))
        return F.xxhash64(k, F.slice(words, start + depth + 1, end - start))

    return F.transform(F.sequence(F.lit(0), runs - 1), run)


def keepers_by_block(rest: DataFrame, large: DataFrame, depth: int, similar: float) -> DataFrame:
    """``rest`` with ``keeper``, as its forms have it among the founders of their leaves. Forms are
    compared with the founders they have a block in common with."""
    keys = ["leaf", "n", "block"]
    founders = large.select("leaf", "n", F.explode("founders").alias("founder"))
    founders = founders.withColumn("block", F.explode(blocks(F.col("founder.words"), F.col("n"), depth, similar)))
    founders = founders.groupBy(keys).agg(F.array_sort(F.collect_list("founder")).alias("founders"))
    own = F.explode(blocks(F.split("form", " "), F.col("n"), depth, similar)).alias("block")
    met = met_by(rest.select("leaf", "n", "f1", "f2", "form", own), founders, keys, "f1")
    # The first of the founders alike is that of the earliest document.
    found = met.groupBy("leaf", "n", "f1", "f2").agg(F.min(form_keeper(similar)).alias("keeper"))
    return rest.join(found.where("keeper is not null"), ["leaf", "n", "f1", "f2"], "left")


def form_keeper(similar: float) -> Column:
    """``keeper_among`` the column ``founders`` for ``form``."""
    # Within a lambda the form is split once, not once for every founder.
    keeper = F.transform(F.array(F.split("form", " ")), lambda words: keeper_among(F.col("founders"), words, similar))
    return F.get(keeper, F.lit(0))


def settled(forms: DataFrame, depth: int, similar: float) -> DataFrame:
    """(f1, f2, last, keeper) of the forms (leaf, n, f1, f2, first, last, form): the first
    document that holds a line of a form's template.

    Every round founds templates among the earliest forms that have none, four times as many
    as the round before; all forms alike join them. A form that is left is unlike all founders
    so far, so the next round goes on as if there were one round. Leaves with no more forms
    than that are done at once. Each round is stored.
    """
    # Two forms of so few tokens differ in too large a share of them.
    short = F.col("n") * F.lit(1 - similar) < 1 - 1e-9
    done = forms.where(short).select("f1", "f2", "last", F.col("first").alias("keeper"))
    rest, most = forms.where(~short), FOUNDERS
    while True:
        leaves = earliest(rest, most).withColumn("founders", founders_of(F.col("early"), similar))
        leaves = stored(leaves, "nodes")
        members = F.transform(
            "early",
            lambda e: F.struct(
                e["f1"].alias("f1"), e["f2"].alias("f2"), e["last"].alias("last"),
                keeper_among(F.col("founders"), e["words"], similar).alias("keeper"),
            ),
        )
        done = done.unionByName(leaves.where("whole").select(F.inline(members)))
        large = leaves.where("not whole").select("leaf", "n", "founders")
        n_large = large.count()
        if not n_large:
            return done
        if n_large <= BROADCAST_ROWS:
            rest = rest.join(F.broadcast(large.select("leaf", "n")), ["leaf", "n"], "left_semi")
        else:
            rest = met_by(rest, large.select("leaf", "n"), ["leaf", "n"], "f1", "left_semi")
        if most == FOUNDERS:
            met = met_by(rest, large, ["leaf", "n"], "f1").withColumn("keeper", form_keeper(similar)).drop("founders")
        else:
            met = keepers_by_block(rest, large, depth, similar)
        met = stored(met, "templates")
        done = done.unionByName(met.where("keeper is not null").select("f1", "f2", "last", "keeper"))
        rest, most = met.where("keeper is null").drop("keeper"), min(4 * most, MOST_FOUNDERS)


def keepers(lines: DataFrame, depth: int = DEPTH, similar: float = SIMILAR) -> DataFrame:
    """(f1, f2, keeper) for every form of the stored ``lines`` that several documents hold, or
    another form of its template an earlier one: the document that keeps its lines.

    Leaves that one document reaches are ruled out by minima and maxima, and leaves with one
    form need no text. Lines of the others meet as distinct forms, each with its first and
    last document.
    """
    leaves = stored(
        lines.groupBy("leaf", "n").agg(
            F.min("doc").alias("first"), F.max("doc").alias("last"),
            F.min("f1").alias("f1"), F.max("f1").alias("other1"),
            F.min("f2").alias("f2"), F.max("f2").alias("other2"),
        ).where("first <> last"),
        "leaves",
    )
    single = (F.col("f1") == F.col("other1")) & (F.col("f2") == F.col("other2"))
    alone = leaves.where(single).select("f1", "f2", F.col("first").alias("keeper"))
    mixed = leaves.where(~single).select("leaf", "n")
    if mixed.count() <= BROADCAST_ROWS:
        shared = lines.join(F.broadcast(mixed), ["leaf", "n"], "left_semi")
    else:
        shared = met_by(lines, mixed, ["leaf", "n"], "body")
    # A text is shuffled once for every form of a task.
    forms = stored(
        shared.groupBy("leaf", "n", "f1", "f2").agg(
            F.min("doc").alias("first"), F.max("doc").alias("last"), F.first("form").alias("form")
        ),
        "forms",
    )
    found = settled(forms, depth, similar).where("last <> keeper").drop("last")
    return alone.unionByName(found)


def dropped_lines(docs: DataFrame, depth: int = DEPTH, similar: float = SIMILAR) -> DataFrame:
    """(key, body, dropped): places of the lines that go, for rows that lose any. Texts are
    split and masked once; the lines are stored."""
    lines = stored(lines_of(docs, depth), "lines")
    decisions = stored(keepers(lines, depth, similar), "keepers")
    lines = lines.select("key", "body", "doc", "place", "f1", "f2")
    if decisions.count() <= BROADCAST_ROWS:
        met = lines.join(F.broadcast(decisions), ["f1", "f2"])
    else:
        met = met_by(lines, decisions, ["f1", "f2"], "body")
    gone = met.where("doc <> keeper")
    return gone.groupBy("key", "body").agg(F.collect_set("place").alias("dropped"))


def drop_recurring_lines(docs: DataFrame, depth: int = DEPTH, similar: float = SIMILAR) -> DataFrame:
    """``docs`` with their texts less the lines whose template occurs in an earlier
    document, and with the column ``dropped`` (places of these lines, or null).

    The first document, by doc_id, keeps its lines; repeats within one document
    stay. Documents stay too, with an empty text if all lines go. Blank lines
    never go; null texts stay null; rows with a null doc_id count as one last
    document; repeated rows lose the same lines; a ``dropped`` the table has is
    replaced.
    """
    dropped = dropped_lines(docs, depth, similar)
    salts = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("salt")
    rows = docs.drop("dropped").select(
        F.struct("*").alias("doc"),
        null_key(F.col("doc_id")).alias("key"),
        F.xxhash64("text").alias("body"),
        F.pmod(F.monotonically_increasing_id(), F.lit(8)).cast("int").alias("salt"),
    )
    met = rows.join(dropped.select("*", salts), ["key", "body", "salt"], "left")
    lines = F.split("doc.text", "\n")

    def without_dropped(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
        return F.array_join(F.transform(kept, lambda place: F.get(lines, place)), "\n")

    # Within a lambda the text is split once, not once for every line.
    text = F.get(F.transform(F.array(lines), without_dropped), F.lit(0))
    clean = F.when(F.col("dropped").isNull(), F.col("doc.text")).otherwise(text)
    columns = [
        (clean if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns if c != "dropped"
    ]
    return met.select(*columns, "dropped")
