"""Benchmark decontamination by templates, also of questions with other parameters.

A text becomes a list of tokens; numbers, names (capitals inside a sentence) and units
after a number become typed placeholders, every other token its lower-case form. Windows
of eight template tokens with at least five plain words are hashed on the side of the
benchmark, and so are the tokens themselves in lower case, with any number of slots, so
that copies in other case or wrapping and items full of slots are found; the windows of all documents are joined to
them by hash. Windows whose tokens are the item's leak it ("exact") whatever stands beside
them. Others are judged by runs of adjacent windows: a run leaks an item too ("parameters")
if each value of a placeholder in the item stands for one value throughout the run.

Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import stored

WINDOW, LEAST_PLAIN = 8, 5
#: Index rows (hash, item, place: some 40 bytes each) up to which the index is broadcast.
BROADCAST_ROWS = 1_000_000
#: Units that a number may have.
UNITS = (
    "kg g mg lb oz km m cm mm mi ft in l ml h min s ms hours hour minutes minute seconds second "
    "days day weeks week months month years year miles meters metres dollars dollar euros euro cents "
    "percent degrees usd eur gbp kmh mph"
).split()
NAME_MARK = "\ue000"
# Possessive repeats: the others recurse once for each part of a number, however many.
TOKEN = NAME_MARK + r"?\p{L}[\p{L}\p{M}]*|\p{N}++(?:[.,:/]\p{N}++)*+|[%$€£]"
NUMBER, NAME, UNIT = "\ue001", "\ue002", "\ue003"


def tokens_of(text: Column) -> Column:
    """Tokens of a text; a name keeps a mark before it."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"([\p{L}\p{N},;)] )(\p{Lu})", "$1" + NAME_MARK + "$2")
    return F.regexp_extract_all(marked, F.lit(f"({TOKEN})"), F.lit(1))


def _is_number(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    return (first >= "0") & (first <= "9")


def template_of(tokens: str) -> Column:
    """The template tokens of a column of tokens."""
    units = [*UNITS, "%", "$", "€", "£"]

    def placeholder(token: Column, i: Column) -> Column:
        lower = F.lower(token)
        after_number = F.lower(token).isin(units) & (i > 0) & _is_number(F.get(F.col(tokens), i - 1))
        return (
            F.when(F.startswith(token, F.lit(NAME_MARK)), F.lit(NAME))
            .when(_is_number(token), F.lit(NUMBER))
            .when(after_number, F.lit(UNIT))
            .otherwise(lower)
        )

    return F.transform(tokens, placeholder)


def _split(texts: DataFrame, keep: list[str]) -> DataFrame:
    """Add ``tokens``, ``template`` and ``plain``, the lower-case tokens without placeholders."""
    split = texts.select(*keep, tokens_of(F.col("text")).alias("tokens"))
    return split.select("*", template_of("tokens").alias("template"), F.transform("tokens", lambda t: F.lower(F.translate(t, NAME_MARK, ""))).alias("plain"))


def _windows(form: str) -> Column:
    """``(place, hash)`` of each window of a column of tokens, as an array.

    Arrays are exploded in the outer form: the inner form makes the optimizer derive a
    filter on the array's size and push it below these steps, written out in full, which
    evaluates all of them again for each element.
    """
    places = F.size(form) - (WINDOW - 1)
    made = F.transform(F.sequence(F.lit(0), places - 1), lambda i: F.struct(i.alias("place"), _window_hash(form, i).alias("hash")))
    return F.when(places > 0, made).otherwise(F.array().cast("array<struct<place:int,hash:bigint>>"))


def _all_windows() -> Column:
    """``(place, hash, exact)``: the template windows, and the exact ones where they differ.

    A window without placeholders is its own template, so it is listed once.
    """
    last = F.size("template") - WINDOW
    slots = F.array_compact(F.transform("template", lambda t, i: F.when(_is_slot(t), i)))
    around = F.transform(slots, lambda i: F.sequence(F.greatest(i - (WINDOW - 1), F.lit(0)), F.least(i, last)))
    differing = F.transform(F.array_distinct(F.flatten(around)), lambda i: F.struct(i.alias("place"), _window_hash("plain", i).alias("hash"), F.lit(True).alias("exact")))
    typed = F.transform(_windows("template"), lambda w: F.struct(w["place"].alias("place"), w["hash"].alias("hash"), F.lit(False).alias("exact")))
    return F.when(last >= 0, F.concat(typed, differing)).otherwise(F.array().cast("array<struct<place:int,hash:bigint,exact:boolean>>"))


def _window_hash(form: str, i: Column) -> Column:
    # Elements by place: slice() would copy the whole array for each window.
    return F.xxhash64(*[F.get(form, i + k) for k in range(WINDOW)])


def _is_slot(token: Column) -> Column:
    return token.isin(NUMBER, NAME, UNIT)


def item_texts(benchmark: DataFrame) -> DataFrame:
    """``(item_id, text_id, class_id, tokens, template, plain)`` of the distinct items.

    Items with one and the same whole template are a class.
    """
    ids = [F.xxhash64("tokens").alias("text_id"), F.xxhash64("template").alias("class_id")]
    return _split(benchmark, ["item_id"]).select("item_id", *ids, "tokens", "template", "plain").dropDuplicates(["item_id", "text_id"])


def window_index(texts: DataFrame) -> DataFrame:
    """``(hash, exact, owner, item_place)``: all places of the windows of all items.

    The qualified template windows have classes as owners; the exact ones, with any number
    of slots, have texts. Empty arrays leave a row without a hash, which joins nothing.
    """
    classes = texts.dropDuplicates(["class_id"]).select(F.lit(False).alias("exact"), F.col("class_id").alias("owner"), "template", F.inline_outer(_windows("template")))
    plain = F.size(F.filter(F.slice("template", F.col("place") + 1, F.lit(WINDOW)), lambda t: ~_is_slot(t)))
    copies = texts.dropDuplicates(["text_id"]).select(F.lit(True).alias("exact"), F.col("text_id").alias("owner"), F.inline_outer(_windows("plain")))
    found = classes.filter(plain >= LEAST_PLAIN).drop("template").union(copies)
    return found.select("hash", "exact", "owner", F.col("place").alias("item_place"))


def _cut(form: str, low: Column, n: Column) -> Column:
    return F.slice(F.col(form), low + 1, n)


def _runs(places: str) -> Column:
    """``(low, last)`` of each maximal run of adjacent places in a sorted array."""
    lows = F.filter(places, lambda p, i: (i == 0) | (F.get(places, i - 1) < p - 1))
    lasts = F.filter(places, lambda p, i: (i == F.size(places) - 1) | (F.get(places, i + 1) > p + 1))
    return F.arrays_zip(lows.alias("low"), lasts.alias("last"))


def _slot_pairs() -> Column:
    """Distinct values (in the item, in the document) of the placeholders that both have at a place."""
    both = F.arrays_zip("here_kinds", "here", "there_kinds", "there")
    slots = F.filter(both, lambda s: _is_slot(s["here_kinds"]) & (s["here_kinds"] == s["there_kinds"]))
    return F.array_distinct(F.transform(slots, lambda s: F.struct(F.lower(s["there"]).alias("there"), F.lower(s["here"]).alias("here"))))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``(key, item_id, kind, n_windows, first_token, end_token)`` of each leaked item.

    One row for each document, item and alignment of the two, "exact" if all its windows
    are. The row covers the exact windows and the runs with consistent slots. A window that several items
    share counts for each of them. Null and empty texts, and items shorter than a window,
    match nothing. Repeated rows (same key and text) count once; a null key is a key.
    Either table may be empty. Only the named columns are read.
    """
    texts = stored(item_texts(benchmark.select(F.col(item).alias("item_id"), F.col(item_text).alias("text"))), "item-texts")
    index = stored(window_index(texts), "window-index")
    if index.count() <= BROADCAST_ROWS:
        index = F.broadcast(index)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("print"))
    windows = _split(rows, ["key", "print"]).select("key", "print", F.inline_outer(_all_windows())).withColumnRenamed("exact", "only_exact")
    matched = windows.join(index, "hash").filter(~F.col("only_exact") | F.col("exact"))
    matched = matched.select("key", "print", "exact", "owner", (F.col("place") - F.col("item_place")).alias("shift"), "place")
    places = matched.groupBy("key", "print", "exact", "owner", "shift").agg(F.array_sort(F.collect_set("place")).alias("places"))
    runs = stored(places.select("key", "print", "exact", "owner", "shift", F.inline(_runs("places"))), "window-runs")
    typed = runs.filter(~F.col("exact"))
    wanted = typed.select(F.col("key").alias("k"), F.col("print").alias("p")).distinct()
    leaking = rows.join(wanted, F.col("key").eqNullSafe(F.col("k")) & (F.col("print") == F.col("p")), "left_semi").dropDuplicates(["key", "print"])
    doc_side = _split(leaking, ["key", "print"]).select(F.col("key").alias("k"), F.col("print").alias("p"), "tokens", "template")
    n, item_low = F.col("last") - F.col("low") + WINDOW, F.col("low") - F.col("shift")
    here = typed.join(doc_side, F.col("key").eqNullSafe(F.col("k")) & (F.col("print") == F.col("p"))).select(
        "key", "print", "exact", "owner", "shift", "low", "last", _cut("tokens", F.col("low"), n).alias("here"), _cut("template", F.col("low"), n).alias("here_kinds")
    )
    aligned = here.join(texts, F.col("owner") == F.col("class_id"))
    aligned = aligned.withColumn("there", _cut("tokens", item_low, n)).withColumn("there_kinds", _cut("template", item_low, n))
    compared = aligned.withColumn("pairs", _slot_pairs())
    consistent = F.size(F.array_distinct(F.transform("pairs", lambda p: p["there"]))) == F.size("pairs")
    columns = ["key", "print", "item_id", "shift", "exact", "low", "last"]
    copied = runs.filter("exact").join(texts.select("item_id", "text_id"), F.col("owner") == F.col("text_id"))
    accepted = compared.filter(consistent).select(*columns).union(copied.select(*columns))
    every = F.sequence("low", "last")
    united = lambda runs: F.size(F.array_distinct(F.flatten(F.collect_list(runs))))
    found = accepted.groupBy("key", "print", "item_id", "shift").agg(
        united(every).alias("n_windows"), united(F.when(F.col("exact"), every)).alias("n_exact"), F.min("low").alias("low"), (F.max("last") + WINDOW).alias("high")
    )
    return found.select(
        F.col("key").alias(key),
        "item_id",
        F.when(F.col("n_exact") == F.col("n_windows"), "exact").otherwise("parameters").alias("kind"),
        F.col("n_windows").cast("long").alias("n_windows"),
        F.col("low").alias("first_token"),
        F.col("high").alias("end_token"),
    )


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that leak no item; a null key is never taken for another row's."""
    mark = F.struct("*").alias("_row")
    rows = docs.select(mark, F.col(key).alias("_key"), F.xxhash64(F.col(text)).alias("_print"))
    named = rows.select(F.struct("_key", "_print").alias("who"), F.col(f"_row.{text}").alias("text"))
    leaks = find_leaks(named, benchmark, "text", "who").select("who").distinct()
    leaks = leaks.select(F.col("who._key").alias("k"), F.col("who._print").alias("p"))
    return rows.join(leaks, F.col("_key").eqNullSafe(F.col("k")) & (F.col("_print") == F.col("p")), "left_anti").select("_row.*")
