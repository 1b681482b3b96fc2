"""Personal data: found by patterns, and terms that reveal it found by co-occurrence in the corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.llm.bloom import Filter
from newsmill.session import cut

# Characters on either side of a mention that are its context.
CONTEXT = 80
# Unlike contexts, and documents, in which a term must accompany an entity before anything is concluded.
SUPPORT = 2
# Shares of what there is to learn about an entity that a term may give away, before it is generalised
# and before it is removed.
GENERALISE, REMOVE = 0.75, 0.9
# Buckets of the filter that keeps words which are no candidates out of the count.
BUCKETS = 1 << 16

KINDS = ("email", "ip", "card", "phone")
_ORDER = (*KINDS, "generalise", "remove")
_WORD = r"[\p{L}\p{M}\p{N}]++"

# The patterns find what these find, leftmost and without overlap, in time that is linear in the text:
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+    ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+ with 16 to 19 digits            phone \+[0-9][\x20().0-9-]+[0-9]
# A run of characters is tried from its start only (or from the end of the match before).
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
_CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_SMALL = r"\A(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|\z)){4}\z"

_SPAN = "struct<kind:string,start:int,stop:int>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.char_length(number)

    def add(total: Column, k: Column) -> Column:
        digit = F.substr(number, n - k, F.lit(1)).cast("int")
        twice = 2 * digit
        return total + F.when(k % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def located(text: Column, pattern: str, keep: Callable[[Column], Column], kind: str) -> Column:
    """Array of ``kind, start, stop`` (code points, end excluded) of the matches that pass ``keep``.

    What lies between the matches and the matches in turn make up the text, so their lengths add up to the
    positions.
    """
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    turns = F.zip_with(between, matches, lambda b, m: F.struct(b.alias("b"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.char_length(turn["b"])
        stop = begin + F.coalesce(F.char_length(turn["m"]), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), stop.alias("stop"))
        kept = F.coalesce(keep(turn["m"]), F.lit(False))
        return F.struct(stop.alias("at"), F.when(kept, F.array_append(state["found"], span)).otherwise(state["found"]).alias("found"))

    return F.aggregate(turns, start, step, lambda s: s["found"])


def _looks(text: Column) -> Column:
    """A cheap test that every text with a span passes."""
    return F.contains(text, F.lit("@")) | F.rlike(text, F.lit("[0-9]"))


def base_spans(text: Column) -> Column:
    """Spans of all four kinds, in the order of kinds and then of places; ``text`` must not be NULL."""
    none = F.array().cast(f"array<{_SPAN}>")
    digit_count = lambda m: F.char_length(digits(m))
    email = F.when(F.contains(text, F.lit("@")), located(text, _EMAIL, lambda m: m.isNotNull(), "email"))
    ip = F.when(F.rlike(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")), located(text, _IP, lambda m: F.rlike(m, F.lit(_SMALL)), "ip"))
    card = F.when(F.rlike(text, F.lit(_CARD)), located(text, _CARD, lambda m: luhn(digits(m)), "card"))
    phone = F.when(F.rlike(text, F.lit(r"\+[0-9]")), located(text, _PHONE, lambda m: digit_count(m).between(8, 15), "phone"))
    return F.when(_looks(text), F.concat(*[F.coalesce(c, none) for c in (email, ip, card, phone)])).otherwise(none)


def _entity(text: Column, span: Column) -> Column:
    """Kind and value of a mention; spellings of one number are one value."""
    found = F.substr(text, span["start"] + 1, span["stop"] - span["start"])
    value = F.when(span["kind"].isin("card", "phone"), digits(found)).otherwise(F.lower(found))
    return F.concat(span["kind"], F.lit(":"), value)


def _terms(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))
    return F.array_distinct(F.filter(words, lambda w: (F.char_length(w) >= 3) & F.rlike(w, F.lit(r"\p{L}"))))


def _context(text: Column, span: Column) -> Column:
    """The whole words around a mention; a word that the window cuts is left out."""
    begin = F.greatest(span["start"] - CONTEXT, F.lit(0))
    before = F.substr(text, begin + 1, span["start"] - begin)
    after = F.substr(text, span["stop"] + 1, F.lit(CONTEXT))
    before = F.when(begin > 0, F.regexp_replace(before, r"\A\S*+", "")).otherwise(before)
    after = F.when(F.char_length(after) == CONTEXT, F.regexp_replace(after, r"(?<!\S)\S++\z", "")).otherwise(after)
    return F.concat(before, F.lit(" "), after)


def _mention(text: Column, span: Column) -> Column:
    return F.struct(_entity(text, span).alias("entity"), F.xxhash64(_context(text, span)).alias("context"))


def mentions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row_key, doc_id, spans, mentions`` of every row; a mention is an entity with its context."""
    rows = docs.select(F.xxhash64(col(id_col), col(text_col)).alias("row_key"), col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    found = rows.withColumn("spans", base_spans(F.col("text")))
    return found.select("row_key", "doc_id", "spans", F.transform("spans", lambda s: _mention(F.col("text"), s)).alias("mentions"))


def _texts(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row_key, text`` of the rows in ``keys``, once each. Texts that a filter of the keys rules out are not
    shuffled."""
    rows = docs.select(F.xxhash64(col(id_col), col(text_col)).alias("row_key"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    likely = Filter(keys, "row_key").mark(rows, F.col("row_key"), "maybe").where("maybe").drop("maybe")
    return likely.join(keys.select("row_key").distinct(), "row_key", "left_semi").dropDuplicates(["row_key"])


def _held(seen: DataFrame, support: int, total: int) -> DataFrame:
    """``row_key, entity, context, n, n_entity``: the documents of entities with ``support`` documents and
    contexts, ``n`` being the rows that repeat one. All contexts of an entity in a document are one value."""
    holding = seen.where(F.size("mentions") > 0)
    one = holding.select("row_key", F.explode("mentions").alias("m")).select("row_key", "m.entity", "m.context")
    held = one.groupBy("row_key", "entity").agg(F.xxhash64(F.sort_array(F.collect_set("context"))).alias("context"))
    held = held.join(holding.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")), "row_key")
    sizes = held.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.countDistinct("context").alias("contexts"), F.countDistinct("row_key").alias("n_docs"))
    often = sizes.where((F.col("contexts") >= support) & (F.col("n_docs") >= support) & (F.col("n_entity") < total))
    return held.join(often.select("entity", "n_entity"), "entity")


def disclosing(docs: DataFrame, seen: DataFrame, id_col: str, text_col: str, support: int, generalise: float, remove: float) -> DataFrame:
    """``entity, term, share, action``: the terms that give away more of an entity than they may.

    With counts of rows over the whole corpus, a term and an entity that it accompanies share the
    information log(n(both) N / (n(term) n(entity))); the entity itself holds log(N / n(entity)). The
    share of the two is 1 for a term that never occurs without the entity. A term accompanies an entity
    wherever it stands in a document with it.
    """
    total = seen.count()
    held = cut(_held(seen, support, total))
    entities = held.groupBy("row_key").agg(F.collect_list(F.struct("entity", "context", "n", "n_entity")).alias("entities"))
    text = F.col("text")
    named = lambda words, free: F.transform(words, lambda w: F.struct(w.alias("term"), F.lit(free).alias("free")))
    free = _terms(F.regexp_replace(text, r"\S*[@0-9]\S*", " "))  # other mentions are no terms
    words = _texts(docs, held, id_col, text_col).join(entities, "row_key").select("row_key", "entities", F.explode(F.concat(named(_terms(text), False), named(free, True))).alias("w"))
    pairs = words.select("w.term", "w.free", F.explode("entities").alias("e")).select("e.entity", "e.n_entity", "term", "free", "e.context", "e.n")
    once = lambda c: F.sum(F.when(~F.col("free"), c).otherwise(0))
    both = pairs.groupBy("entity", "n_entity", "term", "context").agg(once(F.col("n")).alias("n"), once(F.lit(1)).alias("docs"), F.max("free").alias("free"))
    both = both.groupBy("entity", "n_entity", "term").agg(F.count(F.lit(1)).alias("contexts"), F.sum("docs").alias("docs"), F.sum("n").alias("n_both"), F.max("free").alias("free"))
    candidates = cut(both.where(F.col("free") & (F.col("contexts") >= support) & (F.col("docs") >= support)).select("entity", "n_entity", "term", "n_both"))
    bucket = lambda term: F.pmod(F.xxhash64(term), F.lit(BUCKETS))
    # At most BUCKETS rows, however many candidates there are.
    buckets = candidates.select(bucket(F.col("term")).alias("bucket")).distinct()
    counted = docs.select(F.explode(_terms(col(text_col))).alias("term")).withColumn("bucket", bucket(F.col("term")))
    likely = counted.join(F.broadcast(buckets), "bucket", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    share = F.log2(F.col("n_both") * F.lit(total) / (F.col("n_term") * F.col("n_entity"))) / F.log2(F.lit(total) / F.col("n_entity"))
    scored = candidates.join(likely, "term").withColumn("share", share).where(F.col("share") >= generalise)
    return scored.select("entity", "term", "share", F.when(F.col("share") >= remove, "remove").otherwise("generalise").alias("action"))


def _term_spans(docs: DataFrame, seen: DataFrame, revealing: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row_key, term_spans`` of the rows that hold an entity together with a term that reveals it."""
    held = seen.select("row_key", F.explode("mentions.entity").alias("entity")).distinct()
    touched = cut(held.join(revealing.select("entity").distinct(), "entity", "left_semi"))
    texts = cut(_texts(docs, touched, id_col, text_col))
    words = texts.select("row_key", F.explode(_terms(F.col("text"))).alias("term"))
    marks = words.join(touched, "row_key").join(revealing, ["entity", "term"]).groupBy("row_key", "term").agg(F.max("action").alias("action"))
    per_row = marks.groupBy("row_key").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("actions"))
    actions = F.col("actions")
    spot = lambda word: F.element_at(actions, F.lower(word))
    spans = F.concat(*[located(F.col("text"), _WORD, lambda w, a=a: spot(w) == a, a) for a in ("generalise", "remove")])
    return texts.join(per_row, "row_key").select("row_key", spans.alias("term_spans"))


def find(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE,
) -> DataFrame:
    """``row_key``, ``doc_id``, ``base`` and ``spans`` for every row: arrays of ``kind, start, stop`` in code
    points of the whole text, in the order of kinds and places.

    ``base`` are e-mail addresses, IP addresses, card and phone numbers by pattern. ``spans`` has also the
    words that give them away: of an entity that ``support`` or more documents mention, in
    unlike contexts, words of the same documents that share ``generalise`` (or ``remove``) of its information, wherever they stand
    in a document with that entity. Copies of a document are one context. Words inside base spans stay
    part of these.

    A NULL or empty text has no spans. ``row_key`` is a hash of id and text; repeated rows get equal
    results, ids may be NULL. Further columns are ignored.
    """
    seen = cut(mentions(docs, id_col, text_col))
    revealing = cut(disclosing(docs, seen, id_col, text_col, support, generalise, remove))
    if revealing.isEmpty():
        more = seen.select("row_key", "doc_id", "spans", F.array().cast(f"array<{_SPAN}>").alias("term_spans"))
    else:
        more = seen.select("row_key", "doc_id", "spans").join(_term_spans(docs, seen, revealing, id_col, text_col), "row_key", "left")
    base = F.col("spans")
    free = F.filter(F.col("term_spans"), lambda t: ~F.exists(base, lambda b: (t["start"] < b["stop"]) & (b["start"] < t["stop"])))
    return more.select("row_key", "doc_id", base.alias("base"), F.concat(base, F.coalesce(free, F.array().cast(f"array<{_SPAN}>"))).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:stop``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def cleaned(text: Column, spans: Column) -> Column:
    """The text with each span replaced: mentions by their kind, generalised words by their form, removed
    words by nothing. Spans that overlap are replaced as one, by the first and longest."""
    in_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("longest"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        word = F.substr(text, s["start"] + 1, s["stop"] - s["start"])
        form = F.when(F.rlike(word, F.lit(r"\A\p{Lu}")), F.lit("[NAME]")).otherwise(F.lit("[TERM]"))
        mark = F.when(s["kind"] == "remove", F.lit("")).when(s["kind"] == "generalise", form).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        gap = F.substr(text, state["at"] + 1, s["start"] - state["at"])
        parts = F.when(s["start"] >= state["at"], F.array_append(F.array_append(state["parts"], gap), mark)).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), parts.alias("parts"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substr(text, state["at"] + 1, F.char_length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(in_place, start, step, finish)).otherwise(text)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds) -> DataFrame:
    """``docs`` with personal data and the words that reveal it replaced in ``text_col``; all rows and columns
    stay, a NULL text stays NULL."""
    key, spans, maybe = "_nm_row_key", "_nm_spans", "_nm_maybe"
    found = find(docs, id_col, text_col, **thresholds).where(F.size("spans") > 0)
    found = cut(found.select(F.col("row_key").alias(key), F.col("spans").alias(spans)).dropDuplicates([key]))
    marked = Filter(found, key).mark(docs.withColumn(key, F.xxhash64(col(id_col), col(text_col))), F.col(key), maybe)
    changed = marked.where(F.col(maybe)).join(found, key, "left")
    new = F.when(F.col(spans).isNotNull(), cleaned(col(text_col), F.col(spans))).otherwise(col(text_col))
    names = [col(c) for c in docs.columns]
    return marked.where(~F.col(maybe)).select(*names).unionByName(changed.withColumn(text_col, new).select(*names))


def counts(found: DataFrame) -> DataFrame:
    """The result of :func:`find` as counts per kind, a hash of the base spans and all spans as text."""
    kinds = F.col("base.kind")
    per_kind = [F.size(F.array_remove(kinds, k)) for k in KINDS]
    per_kind = [(F.size(kinds) - n).cast("long").alias(f"n_{k}") for k, n in zip(KINDS, per_kind)]
    return found.select("doc_id", *per_kind, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
