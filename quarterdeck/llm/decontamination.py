"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Words are canonicalised: numbers, names (capitalised words) and units become typed placeholders,
other words count by their hash. Every window of four words of a document is joined by hash with
all windows of the benchmark's items, once as a template and once word by word in lower case, so
that re-cased copies and items made of placeholders are found too. A hit fixes an alignment of a
document with an item; alignments whose shifts lie close together (words inserted or left out) are
one. Along each alignment every word of the item is compared, and slot by slot: a leak fills equal
slots of the item with equal values throughout, so a question whose names and numbers were
replaced is caught, and a passage that only looks alike is not. Each alignment is judged alone.
Short items have windows of three words and need their whole template at one alignment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.base import packed, small_side, staged

WINDOW = 4  # index windows of items of 12 words or more
SHORT_WINDOW = 3  # of shorter ones; under three words they are not looked for
LONG_ITEM = 12
COVERAGE = 0.5  # share of an item's words that agree along an alignment
SHORT_COVERAGE = 0.8  # share of a short item's literal words; its slots must all agree
VERBATIM, RUN = 0.9, 8  # share of equal words, and length of equal runs, that need no agreeing slots
LITERALS = 0.5  # share of a template window's words that are not placeholders
LEAST_LITERALS, SHORT_LEAST_LITERALS = 4, 2  # equal literal words that a re-parameterised item needs
NEARBY = 3  # words on either side that decide which shift of an alignment a word follows
BROADCAST_WINDOWS = 500_000  # of the benchmark, about 30 MB; more are joined by shuffle

# Words of the placeholder type "unit".
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "percent degree degrees dollar dollars cent cents euro euros meter meters metre metres kilometer kilometers watt watts volt volts"
).split()
_NUMBER, _NAME, _UNIT = 1, 2, 3
# All ASCII but letters and digits; a point or comma before a digit belongs to a number.
_BREAK = r"[\x00-\x2B\x2D\x2F\x3A-\x40\x5B-\x60\x7B-\x7F][\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*|[.,](?![0-9])[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"


def template_words(text: Column) -> Column:
    """The words of a text without punctuation (empty first or last ones are possible)."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), _BREAK)


def _slot(word: Column) -> Column:
    """The placeholder's type, or null for a literal word."""
    number = (word >= "0") & (word < ":")
    return F.when(number, F.lit(_NUMBER)).when(F.lower(word) != word, F.lit(_NAME)).when(word.isin(UNITS), F.lit(_UNIT))


def canonical(words: Column) -> Column:
    """Per word its placeholder's type or the hash of the literal."""
    return F.transform(words, lambda w: F.coalesce(_slot(w).cast("long"), F.xxhash64(w)))


def plain(words: Column) -> Column:
    """Per word the hash of its lower case."""
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def _windows(codes: str, width: int) -> Column:
    """The hash of every window of ``width`` codes."""
    starts = F.sequence(F.lit(0), F.size(codes) - width)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(codes, i + j) for j in range(width)]))
    return F.when(F.size(codes) >= width, hashes)


def _key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def templates(benchmark: DataFrame) -> DataFrame:
    """The distinct items of three words or more: (item_id, item_words, codes, width)."""
    kept = F.filter(template_words(F.col("text")), lambda w: w != "")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), kept.alias("item_words"))
    items = items.where(F.size("item_words") >= SHORT_WINDOW).groupBy("item_words").agg(F.min("item_id").alias("item_id"))
    width = F.when(F.size("item_words") >= LONG_ITEM, WINDOW).otherwise(SHORT_WINDOW)
    return items.select("item_id", "item_words", canonical(F.col("item_words")).alias("codes"), plain(F.col("item_words")).alias("plain"), width.alias("width"))


def _item_windows(items: DataFrame) -> DataFrame:
    """(item_id, item_at, hash) of all windows word by word, and as templates if they have literals enough."""
    parts = []
    for width in (WINDOW, SHORT_WINDOW):
        own = items.where(F.col("width") == width)
        at = own.select("item_id", "codes", F.posexplode(_windows("codes", width)).alias("item_at", "hash"))
        literal = F.size(F.filter(F.slice("codes", F.col("item_at") + 1, width), lambda c: ~c.isin(_NUMBER, _NAME, _UNIT)))
        parts.append(at.where(literal >= LITERALS * width).select("item_id", "item_at", "hash"))
        parts.append(own.select("item_id", F.posexplode(_windows("plain", width)).alias("item_at", "hash")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).distinct()


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that it leaks.

    ``doc_id, doc_key, item_id, found, words, coverage, slots, changed, kind``: ``found`` of the
    item's ``words`` agree along the best alignment that is a leak, ``slots`` values of the item
    stand in placeholders, ``changed`` of them were replaced; ``kind`` is ``verbatim`` or
    ``reparameterised``. Words agree if they are equal in lower case or placeholders of one type.
    An alignment that fills one value of the item with several values is no leak, unless words
    that are equal cover the item as well. Null and empty texts leak nothing; items with the same
    words are one item, with the smallest id; items with fewer than three words are skipped;
    repeated documents each have their row.
    """
    items = templates(benchmark)
    wanted = _item_windows(items)
    # Short items cost a pass of their own over the windows, only where there are any.
    short = not items.where(F.col("width") == SHORT_WINDOW).isEmpty()
    words = template_words(F.col("text"))
    codes = docs.select(_key().alias("doc_key"), canonical(words).alias("codes"), plain(words).alias("plain"))
    seen = _seen(codes, WINDOW)
    if short:
        seen = seen.unionByName(_seen(codes, SHORT_WINDOW))
    if wanted.count() <= BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)
    hits = seen.join(wanted, "hash").groupBy("doc_key", "item_id").agg(F.collect_set(F.col("at") - F.col("item_at")).alias("shifts"))
    hits = staged(hits, "leak-hits")
    near = hits.join(items.select("item_id", "item_words"), "item_id")
    # Only the texts of documents with a hit move, and none before it is known to have one.
    found = small_side(staged(hits.select("doc_key").distinct(), "leak-keys"))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key().alias("doc_key"), F.col("text").cast("string").alias("text"))
    both = rows.join(found, "doc_key", "left_semi").join(near, "doc_key").withColumn("words", template_words(F.col("text"))).drop("text")
    # Written out: an expression pulled into the lambdas below would run once for each word.
    both = staged(both.withColumn("_row", F.monotonically_increasing_id()), "leak-candidates")
    return _best(_judged(_aligned(both)))


def _seen(codes: DataFrame, width: int) -> DataFrame:
    """(doc_key, at, hash) of the windows of the documents, as templates and word by word."""
    # Exploded one by one: an array column here would be written into an inferred filter, once for each word.
    each = [codes.select("doc_key", F.posexplode(_windows(c, width)).alias("at", "hash")) for c in ("codes", "plain")]
    return each[0].unionByName(each[1])


def _aligned(both: DataFrame) -> DataFrame:
    """One row per alignment, with ``pairs``: per word of the item what stands there in the document.

    An alignment is a shift with all shifts up to half an item (a third of a short one) further;
    copies of an item in one document lie further apart. A word follows the shift along which most
    words beside it agree. ``fit`` is 2 for equal words, 1 for placeholders of one type, else 0.
    """
    length = F.size("item_words")
    reach = F.when(length >= LONG_ITEM, F.floor(length / 2)).otherwise(F.floor(length / 3)).cast("int")

    def piece(shift: Column) -> Column:
        start = F.greatest(shift, F.lit(0))
        near = F.transform(F.filter("shifts", lambda s: (s >= shift) & (s <= shift + reach)), lambda s: s - start)
        return F.struct(F.array_sort(near).alias("near"), F.slice("words", start + 1, length + reach).alias("part"))

    cut = both.select("_row", "doc_id", "doc_key", "item_id", "item_words", F.explode(F.transform("shifts", piece)).alias("p"))
    typed = lambda name: F.transform(name, lambda w: F.struct(F.lower(w).alias("word"), F.coalesce(_slot(w), F.lit(0)).alias("slot")))
    parts = cut.select("_row", "doc_id", "doc_key", "item_id", typed(F.col("item_words")).alias("item"), F.col("p.near").alias("near"), typed(F.col("p.part")).alias("part"))
    parts = staged(parts, "leak-parts")
    places = F.sequence(F.lit(0), F.size("item") - 1)

    def fit(i: Column, shift: Column) -> Column:
        one, other = F.get("item", i), F.get("part", i + shift)
        return F.when(one["word"] == other["word"], 2).when((one["slot"] > 0) & (one["slot"] == other["slot"]), 1).otherwise(0)

    fits = staged(parts.withColumn("fits", F.transform("near", lambda s: F.transform(places, lambda i: fit(i, s)))), "leak-fits")

    def followed(i: Column) -> Column:
        first = F.greatest(i - NEARBY, F.lit(0))

        def support(k: Column) -> Column:
            beside = F.slice(F.get("fits", k), first + 1, i + NEARBY + 1 - first)
            return F.struct(F.size(F.filter(beside, lambda f: f > 0)).alias("n"), F.get(F.get("fits", k), i).alias("fit"), (-k).alias("k"))

        return F.array_max(F.transform(F.sequence(F.lit(0), F.size("near") - 1), support))

    chosen = staged(fits.withColumn("best", F.transform(places, followed)).drop("fits"), "leak-chosen")

    def pair(i: Column) -> Column:
        one, best = F.get("item", i), F.get("best", i)
        other = F.get("part", i + F.get("near", -best["k"]))
        return F.struct(one["word"].alias("item"), one["slot"].alias("slot"), other["word"].alias("doc"), best["fit"].alias("fit"))

    return staged(chosen.select("_row", "doc_id", "doc_key", "item_id", F.transform(places, pair).alias("pairs")), "leak-pairs")


def _judged(aligned: DataFrame) -> DataFrame:
    """Keeps the alignments that cover their item and whose slots are consistent or words equal."""

    def count(holds) -> Column:
        return F.size(F.filter("pairs", holds))

    filled = F.array_distinct(F.transform(F.filter("pairs", lambda p: (p["slot"] > 0) & (p["fit"] > 0)), lambda p: F.struct(p["item"], p["doc"])))
    runs = F.filter(F.sequence(F.lit(0), F.size("pairs") - RUN), lambda i: F.forall(F.slice("pairs", i + 1, RUN), lambda p: p["fit"] == 2))
    counted = aligned.select(
        "*", F.size("pairs").alias("words"), count(lambda p: p["fit"] > 0).alias("found"), count(lambda p: p["fit"] == 2).alias("equal"),
        count(lambda p: p["slot"] == 0).alias("literals"), count(lambda p: (p["slot"] == 0) & (p["fit"] > 0)).alias("same"),
        count(lambda p: (p["slot"] > 0) & (p["fit"] == 0)).alias("unfilled"), filled.alias("filled"),
        F.when(F.size("pairs") >= LONG_ITEM, F.size(runs)).otherwise(0).alias("runs"),
    )
    counted = counted.withColumn("slots", F.size(F.array_distinct(F.col("filled.item"))))
    consistent = F.size("filled") == F.col("slots")
    template = (F.col("same") >= COVERAGE * F.col("literals")) & (F.col("same") >= LEAST_LITERALS)
    long = consistent & (F.col("found") >= COVERAGE * F.col("words")) & (template | (F.col("equal") >= COVERAGE * F.col("words")))
    long = long | (F.col("runs") >= COVERAGE * (F.col("words") - RUN + 1))
    short = consistent & (F.col("unfilled") == 0) & (F.col("same") >= SHORT_COVERAGE * F.col("literals")) & (F.col("same") >= SHORT_LEAST_LITERALS)
    whole = F.col("equal") >= VERBATIM * F.col("words")
    return counted.where(F.when(F.col("words") >= LONG_ITEM, long | whole).otherwise(short | whole))


def _best(judged: DataFrame) -> DataFrame:
    """Of each row's alignments with an item the one with most agreeing words."""
    changed = F.size(F.filter("filled", lambda v: v["item"] != v["doc"]))
    one = judged.groupBy("_row", "doc_id", "doc_key", "item_id").agg(
        F.max(F.struct("found", "equal", (-changed).alias("_unchanged"), "words", "slots", changed.alias("changed"))).alias("b")
    )
    return one.select(
        "doc_id", "doc_key", "item_id", "b.found", "b.words", F.round(F.col("b.found") / F.col("b.words"), 6).alias("coverage"), "b.slots", "b.changed",
        F.when(F.col("b.changed") == 0, "verbatim").otherwise("reparameterised").alias("kind"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` without the documents that leak an item."""
    leaks = staged(find_leaks(docs, benchmark).select("doc_key").distinct(), "leak-found")
    return packed(docs, doc_key=_key()).join(small_side(leaks), "doc_key", "left_anti").select("row.*")
