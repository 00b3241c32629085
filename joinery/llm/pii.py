"""Personal data by information-theoretic sanitisation. Base patterns find the protected
entities; corpus co-occurrence then tells how far a term of their texts gives an entity
away, and terms beyond a disclosure threshold are generalised or removed wherever they
stand. DataFrame functions only."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged
from .texts import free_columns, q

KINDS = ("email", "ip", "card", "phone")
#: Kept for callers that read them: terms are looked for in the whole text.
NEAR_WORDS, NEAR_CHARS = 6, 80
#: Share of an entity's information that a term must give away to be generalised, to be removed.
GENERALISE, REMOVE = 0.9, 0.97
#: Texts in which term and entity must meet before their association is believed.
SUPPORT = 3
#: Letters that a term needs.
TERM_LETTERS = 3
#: Disclosing terms that are broadcast to the words of all texts; more are joined by a shuffle.
BROADCAST_TERMS = 200_000

# Each pattern may only begin where its leftmost match can begin, and gives no character
# back: the same matches as the plain pattern in time linear in the text.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_LETTER = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"
_TERM = _LETTER + "+"
_SPAN = "struct<start:int,end:int,value:string>"


def _none(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


def _placed(text: Column, found: Column, pieces: Column) -> Column:
    """Matches with their code point spans, from the matches and the text between them."""
    start = F.struct(F.lit(0).alias("at"), _none(_SPAN).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["piece"])
        end = begin + F.length(pair["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            begin.alias("start"), end.alias("end"), pair["value"].alias("value")))).alias("out"))

    pairs = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, v: F.struct(p.alias("piece"), v.alias("value")))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _kept(spans: Column, kind: str, number: int) -> Column:
    return F.transform(F.filter(spans, lambda s: _valid(kind, s["value"])), lambda s: F.struct(
        s["start"].alias("start"), F.lit(number).alias("k"), s["end"].alias("end"), s["value"].alias("value")))


def base_spans(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``__base``: the base spans of column ``text`` (kind number ``k``, start,
    end, value), by start, then kind. Every kind is found on its own, leftmost and apart;
    matches that fail its test are dropped, nothing is tried again in their place."""
    t = F.col(text)
    patterns = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
    hint = {"email": t.contains("@"), "ip": t.rlike(r"[0-9]\.[0-9]+\.[0-9]"),
            "card": t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), "phone": t.rlike(r"\+[0-9]")}
    for k in KINDS:
        rows = rows.withColumn(f"__f_{k}", F.when(hint[k], F.regexp_extract_all(t, F.lit(patterns[k]), F.lit(0))).otherwise(_none("string")))
    for k in KINDS:
        rows = rows.withColumn(f"__p_{k}", F.when(F.size(f"__f_{k}") > 0, F.split(t, patterns[k], -1)))
    found = []
    for number, k in enumerate(KINDS):
        spans = F.when(F.size(f"__f_{k}") > 0, _placed(t, F.col(f"__f_{k}"), F.col(f"__p_{k}"))).otherwise(_none(_SPAN))
        found.append(_kept(spans, k, number))
    rows = rows.withColumn("__base", F.array_sort(F.concat(*found)))
    return rows.drop(*[f"__{x}_{k}" for x in "fp" for k in KINDS])


def _outside(text: Column, spans: Column) -> Column:
    """``text`` with blanks in place of the spans (by start), every code point in its place."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], acc["at"])
        end = F.greatest(s["end"], acc["at"])
        before = F.substring(text, acc["at"] + 1, begin - acc["at"])
        return F.struct(end.alias("at"), F.concat(acc["out"], before, F.repeat(F.lit(" "), end - begin)).alias("out"))

    blanked = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, blanked).otherwise(text)


def _terms(text: Column) -> Column:
    """The distinct terms of a text, lower-cased."""
    words = F.transform(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), F.lower)
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= TERM_LETTERS))


def _entity(k: Column, value: Column) -> Column:
    return F.when(k == 0, F.lower(value)).otherwise(F.concat(F.lit("#"), k.cast("string"), F.lit(":"), _digits(value)))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(q(id_col).alias("__id"), F.coalesce(q(text_col).cast("string"), F.lit("")).alias("__text"))
    return rows.withColumn("__th", F.xxhash64("__text"))


def entity_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row of ``docs``: ``__id``, ``__th`` (hash of the text), ``__base``, each base
    span with its entity, and ``__terms``, if there are any the terms outside them. Written
    once; the texts stay behind."""
    rows = base_spans(_texts(docs, id_col, text_col), "__text")
    base = F.transform("__base", lambda s: F.struct(
        s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"), _entity(s["k"], s["value"]).alias("entity")))
    terms = F.when(F.size("__base") > 0, _terms(_outside(F.col("__text"), F.col("__base")))).otherwise(_none("string"))
    return staged(rows.select("__id", "__th", base.alias("__base"), terms.alias("__terms")), "pii_entities")


def document_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``(term, texts)``: rows of the whole corpus that hold each word."""
    words = F.split(F.lower(F.coalesce(q(text_col).cast("string"), F.lit(""))), r"[\x00-\x40\x5B-\x60\x7B-\x7F]+")
    each = docs.select(F.explode(F.array_distinct(words)).alias("term"))
    return each.groupBy("term").agg(F.count(F.lit(1)).alias("texts"))


def disclosures(docs: DataFrame, entities: DataFrame, text_col: str, generalise: float = GENERALISE, support: int = SUPPORT) -> DataFrame:
    """``(term, entity, share)`` of the pairs that disclose.

    An entity e in c(e) of N texts carries log(N / c(e)). A term in c(t, e) texts with it
    (outside base spans) and in c(t) texts of the corpus gives away the pointwise mutual
    information log(N c(t, e) / (c(t) c(e))); ``share`` is their ratio, 1 when the term
    occurs nowhere without the entity. All four count rows, repeated ones as often as they
    come, so that no share depends on how often; ``support`` asks for different (id, text)."""
    n = float(max(entities.count(), 1))
    same = lambda a, b: F.col(f"{a}.__id").eqNullSafe(F.col(f"{b}.__id")) & (F.col(f"{a}.__th") == F.col(f"{b}.__th"))
    held = entities.select("__id", "__th", F.explode(F.array_distinct("__base.entity")).alias("entity"))
    held = held.groupBy("__id", "__th", "entity").agg(F.count(F.lit(1)).alias("rows"))
    by_entity = held.groupBy("entity").agg(F.sum("rows").alias("ce"), F.count(F.lit(1)).alias("own"))
    by_entity = by_entity.filter((F.col("own") >= support) & (F.col("ce") < n)).drop("own")
    held = staged(held.join(by_entity, "entity"), "pii_held")
    some = held.select("__id", "__th").distinct()
    terms = entities.select("__id", "__th", "__terms").distinct().alias("t").join(some.alias("s"), same("t", "s"), "left_semi")
    terms = terms.select("__id", "__th", F.explode("__terms").alias("term"))
    counts = document_counts(docs, text_col).filter(F.col("texts") >= support)
    # c(t, e) is c(e) at most, so a term in more texts than this cannot reach the share
    most = lambda ce: ce * F.pow(n / ce, F.lit(1 - generalise)) * (1 + 1e-9)
    terms = terms.join(counts, "term").alias("t")
    pairs = terms.join(held.alias("h"), same("t", "h") & (F.col("texts") <= most(F.col("ce"))))
    pairs = pairs.groupBy("entity", "term").agg(
        F.sum("rows").alias("cte"), F.count(F.lit(1)).alias("own"), F.first("ce").alias("ce"), F.first("texts").alias("texts"))
    share = F.log(n * F.col("cte") / (F.col("texts") * F.col("ce"))) / F.log(n / F.col("ce"))
    return pairs.filter(F.col("own") >= support).withColumn("share", share).filter(F.col("share") >= generalise).select("term", "entity", "share")


def term_spans(docs: DataFrame, entities: DataFrame, known: DataFrame, id_col: str, text_col: str, remove: float = REMOVE) -> DataFrame:
    """``(__tid, __tth, told)``: of each text that holds terms of ``known`` (term, share)
    outside its base spans, the spans of all of them."""
    rows = _texts(docs, id_col, text_col)
    words = rows.select("__id", "__th", F.explode(_terms(F.col("__text"))).alias("term"))
    # a span can cut a word that touches it
    words = words.unionByName(entities.select("__id", "__th", F.explode("__terms").alias("term")))
    known = staged(known, "pii_known")
    words = words.join(F.broadcast(known) if known.count() <= BROADCAST_TERMS else known, "term")
    hits = words.groupBy(F.col("__id").alias("__tid"), F.col("__th").alias("__tth")).agg(F.collect_set(F.struct("term", "share")).alias("hits"))
    rows = rows.join(hits, F.col("__id").eqNullSafe(F.col("__tid")) & (F.col("__th") == F.col("__tth"))).dropDuplicates(["__tid", "__tth"])
    rows = base_spans(rows, "__text").withColumn("__out", _outside(F.col("__text"), F.col("__base")))
    forms = F.filter(F.array_distinct(F.regexp_extract_all("__out", F.lit(_TERM), F.lit(0))), lambda w: F.array_contains(F.col("hits.term"), F.lower(w)))
    rows = rows.withColumn("__forms", forms).filter(F.size("__forms") > 0)
    # letters only, so nothing to quote
    rows = rows.withColumn("__any", F.concat(F.lit(f"(?<!{_LETTER})(?:"), F.array_join("__forms", "|"), F.lit(f")(?!{_LETTER})")))
    placed = _placed(F.col("__out"), F.regexp_extract_all("__out", F.col("__any"), F.lit(0)), F.split("__out", F.col("__any"), -1))
    share = lambda s: F.filter("hits", lambda h: h["term"] == F.lower(s["value"]))[0]["share"]
    told = F.transform(placed, lambda s: F.struct(
        s["start"].alias("start"), F.lit(len(KINDS)).alias("k"), s["end"].alias("end"), F.lit("term").alias("kind"),
        F.when(share(s) >= remove, "remove").otherwise("generalise").alias("action")))
    return rows.select("__tid", "__tth", told.alias("told"))


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE,
                  remove: float = REMOVE, support: int = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``text_hash`` and ``spans``, an array of
    (start, k, end, kind, action) by start, then kind: the base spans (``mask``), then the
    terms that disclose any entity, wherever they stand (kind ``term``; ``generalise`` or
    ``remove``).

    A term's span never overlaps a base span. Null text is empty; equal rows get equal
    spans. Statistics count rows, repeated ones too, but a term or entity needs ``support``
    different (id, text)."""
    entities = entity_table(docs, id_col, text_col)
    known = disclosures(docs, entities, text_col, generalise, support)
    told = term_spans(docs, entities, known.groupBy("term").agg(F.max("share").alias("share")), id_col, text_col, remove)
    names = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform("__base", lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"),
                                                    names[s["k"]].alias("kind"), F.lit("mask").alias("action")))
    both = entities.join(told, F.col("__id").eqNullSafe(F.col("__tid")) & (F.col("__th") == F.col("__tth")), "left")
    spans = F.array_sort(F.concat(base, F.coalesce("told", F.slice(base, 1, 0))))
    return both.select(F.col("__id").alias(id_col), F.col("__th").alias("text_hash"), spans.alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _replaced(text: Column, spans: Column) -> Column:
    """``text`` with masks for base spans, ``[TERM]`` for generalised and nothing for
    removed terms. A span inside or overlapping an earlier one only extends its mask."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        mask = F.when(s["action"] == "mask", F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))) \
            .when(s["action"] == "generalise", F.lit("[TERM]")).otherwise(F.lit(""))
        fresh = s["start"] >= acc["at"]
        before = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], before, mask)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE,
             remove: float = REMOVE, support: int = SUPPORT) -> DataFrame:
    """Every row of ``docs`` with its text sanitised, and ``spans`` (places in the old
    text). Null text stays null. Arguments as in ``find_personal``."""
    found = find_personal(docs, id_col, text_col, generalise, remove, support).dropDuplicates([id_col, "text_hash"])
    found = found.select(F.col(id_col).alias("__fid"), F.col("text_hash").alias("__fth"), F.col("spans").alias("__spans"))
    keep = free_columns(docs, ["spans"])
    plain = docs.select(*[q(c).alias(f"__c{i}") for i, c in enumerate(keep)])
    ident, text = (F.col(f"__c{keep.index(c)}") for c in (id_col, text_col))
    rows = plain.withColumn("__th", F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))))
    rows = rows.join(found, ident.eqNullSafe(F.col("__fid")) & (F.col("__th") == F.col("__fth")), "left")
    return rows.select(*[(_replaced(text, F.col("__spans")) if c == text_col else F.col(f"__c{i}")).alias(c) for i, c in enumerate(keep)],
                       F.col("__spans").alias("spans"))


