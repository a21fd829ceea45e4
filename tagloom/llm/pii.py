"""PII spans and information-theoretic sanitisation (native: DataFrame functions only).

Base spans are e-mail addresses, IPv4 addresses, payment card numbers (Luhn)
and telephone numbers, found in the whole text by patterns that scan it once.

The method then asks which ordinary terms give a protected entity away. An
entity is a base value found in the corpus; its terms are the words that stand
with it in one unit: a line (scope ``line``, the default) or the whole text
(scope ``text``, as ``op8_pii`` has it). Over the whole corpus, n(e, t)
documents hold entity and term in one unit, df(t) documents hold the term
anywhere, and n(e) hold the entity. A term exceeds the disclosure threshold for
e where

* n(e, t) >= ``MIN_SUPPORT`` documents,
* n(e, t) / df(t) >= ``MIN_SHARE``: who reads the term can infer the entity,
* log2(N * n(e, t) / (n(e) * df(t))) >= ``MIN_BITS`` of pointwise information.

In scope ``text`` every place of such a term becomes a span of kind ``term``, in
whichever document it stands; in scope ``line`` the places in the lines that
hold e do. ``redact`` generalises base values to their kind and removes such
terms. A term is a run of two or more letters, or a single ideograph that stands
alone; runs of ideographs are not cut into words.

Entities and terms are written apart, once a unit, and are joined only where
they can reach the threshold: since n(e, t) is at most n(e) and df(t), only
entities and terms of ``MIN_SUPPORT`` to N / 2 ** ``MIN_BITS`` documents can, and
only in pairs with n(e) >= ``MIN_SHARE`` * df(t). Entities that stand in the very same units
form a class, and so do terms with one df(t): all pairs of two classes have one n(e, t), so
only their least members are joined (a list of addresses and names that several documents
repeat is one pair, not a product). The members of a class are found by the number of its units
and a 128-bit exclusive or of their hashes. A unit with more than ``SALT_ENTITIES`` classes
of entities is dealt over salts. Places are looked up last.
Document frequencies are counted over all texts with partial aggregation; only
the rows of ids that occur more than once are reduced to distinct pairs of id
and term first.

Defined results: a null or empty text has no span; repeated rows with one id
count as one document and each is scanned alike; rows without an id get base
spans but no term spans; an empty table gives an empty table; only doc_id and
text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import Staged
from tagloom.llm.places import let, places, sums_before

#: Kinds in the order of the digest. The patterns equal the plain ones
#: (for an e-mail address ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``, and so on) but
#: start only where a run starts and never go back, so that long runs cost linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9]|(?<=0))"
IP_PARTS = rf"^{_PART}(?:\.{_PART}){{3}}$"

MIN_SUPPORT = 3
MIN_SHARE = 0.8
MIN_BITS = 3.0
SALT_ENTITIES = 256
TERM = r"[\p{L}\p{M}]{2,}|\p{IsHan}"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def worth(k: Column) -> Column:
        d = F.substring(digits, -k, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(k % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, k: a + worth(k)) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.rlike(found, F.lit(IP_PARTS))
    if kind == "card":
        return let(_digits(found), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    return F.lit(True)


KINDS = {"email": (EMAIL, "@"), "ip": (IP, "."), "card": (CARD, None), "phone": (PHONE, "+")}


def base_spans(text: Column, kind: str) -> Column:
    """Valid spans (start, end, found) of one kind in a text that is not null."""
    pattern, mark = KINDS[kind]
    found = F.filter(places(text, F.lit(pattern)), lambda p: _valid(kind, p["found"]))
    if mark is None:
        return found
    return F.when(F.contains(text, F.lit(mark)), found).otherwise(
        F.array().cast("array<struct<start:int,end:int,found:string>>")
    )


def _rendered(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda p: F.concat_ws(":", F.lit(kind), p["start"], p["end"]))


def _named(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda p: F.concat(F.lit(f"{kind}:"), F.lower(p["found"])))


def _replaced(kind: str, spans: Column) -> Column:
    mark = F.lit("" if kind == "term" else f"[{kind.upper()}]")
    return F.transform(spans, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), mark.alias("mark")))


def _blanked(text: Column) -> Column:
    """The text with its base values blanked out, each place where it was."""
    spans = F.array_sort(F.concat(*[F.transform(base_spans(text, kind), lambda p: F.struct(p["start"], p["end"])) for kind in KINDS]))

    def without(found: Column) -> Column:
        return F.aggregate(
            found,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
            lambda a, p: F.struct(
                F.greatest(a["at"], p["end"]).alias("at"),
                F.concat(
                    a["parts"],
                    F.array(
                        F.substring(text, a["at"] + 1, F.greatest(p["start"] - a["at"], F.lit(0))),
                        F.repeat(F.lit(" "), p["end"] - F.greatest(p["start"], a["at"])),
                    ),
                ).alias("parts"),
            ),
            lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, a["at"] + 1, F.length(text))),
        )

    return let(spans, lambda found: F.when(F.size(found) == 0, text).otherwise(without(found)))


def _words(text: Column) -> Column:
    """Distinct terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _term_places(text: Column, terms: Column) -> Column:
    """Places (start, end) of ``terms`` in a text, outside its base values."""
    found = F.filter(places(_blanked(text), F.lit(TERM)), lambda w: F.array_contains(terms, F.lower(w["found"])))
    return F.transform(found, lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end")))


def _units(docs: DataFrame, scope: str) -> DataFrame:
    """doc_id, unit, its text and where it starts: the lines of the texts that can hold a base value, or these texts."""
    text = F.col("text")
    docs = docs.where(F.col("doc_id").isNotNull() & F.rlike(text, F.lit("[0-9@]")))
    if scope == "text":
        return docs.select("doc_id", F.lit(0).alias("unit"), "text", F.lit(0).alias("offset"))
    lines = F.split(text, "\n", -1)
    offsets = sums_before(F.transform(lines, lambda x: F.length(x) + 1))
    return (
        docs.select("doc_id", F.posexplode(F.arrays_zip(lines.alias("line"), offsets.alias("offset"))).alias("unit", "at"))
        .select("doc_id", "unit", F.col("at.line").alias("text"), F.col("at.offset").alias("offset"))
        .where(F.rlike("text", F.lit("@|[0-9].*[0-9]")))
    )


def _frequency(known: DataFrame, n_docs: int, staged: Staged) -> DataFrame:
    """n_term, the documents that hold a term, of the terms that can reach the threshold."""
    # the rows of an id that occurs once are counted as they are, without the ids in the shuffle
    repeated = staged.write(
        known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated"
    )
    once, more = (known.join(repeated, "doc_id", how) for how in ("left_anti", "left_semi"))
    once, more = (x.select("doc_id", F.explode(_words(F.col("text"))).alias("term")) for x in (once, more))
    counts = [x.groupBy("term").agg(F.count(F.lit(1)).alias("n")) for x in (once, more.distinct())]
    total = counts[0].union(counts[1]).groupBy("term").agg(F.sum("n").alias("n_term"))
    return total.where(F.col("n_term").between(MIN_SUPPORT, n_docs / 2**MIN_BITS))


def _classes(rows: DataFrame, name: str, support: str) -> tuple[DataFrame, DataFrame]:
    """``name`` and ``least``, the least value that stands in the same units with the same support; the
    rows of these least values."""
    in_units = ["_units", "_x", "_y", support]
    sets = rows.groupBy(name, support).agg(
        F.count(F.lit(1)).alias("_units"),
        F.bit_xor(F.xxhash64("doc_id", "unit")).alias("_x"),
        F.bit_xor(F.xxhash64("unit", F.lit(name), "doc_id")).alias("_y"),
    )
    least = sets.groupBy(*in_units).agg(F.min(name).alias("least"))
    members = sets.join(least, in_units).select(name, "least")
    chosen = least.select(F.col("least").alias(name))
    return members, rows.join(chosen, name, "left_semi")


def _in_one_unit(held: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows of ``held`` and ``terms`` of one unit side by side; a unit of many entities passes through many tasks."""
    unit = ["doc_id", "unit"]
    crowded = held.groupBy(*unit).agg(F.ceil(F.count(F.lit(1)) / SALT_ENTITIES).cast("int").alias("salts")).where("salts > 1")
    salts = F.coalesce("salts", F.lit(1))
    dealt = held.join(crowded, unit, "left").withColumn("salt", F.pmod(F.xxhash64("entity"), salts).cast("int"))
    copies = terms.join(crowded, unit, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt.drop("salts").join(copies.drop("salts"), [*unit, "salt"]).drop("salt")


def disclosing_terms(docs: DataFrame, staged: Staged, scope: str = "line") -> DataFrame:
    """doc_id, unit and term where a term that exceeds the disclosure threshold is to be marked, once each."""
    known = docs.where("doc_id is not null")
    n_docs = known.select("doc_id").distinct().count()
    units = _units(docs, scope)
    values = F.concat(*[_named(kind, base_spans(F.col("text"), kind)) for kind in KINDS])
    entities = staged.write(
        units.select("doc_id", "unit", F.explode(F.array_distinct(values)).alias("entity")).distinct(), "entities"
    )
    alone = entities.select("doc_id", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    alone = alone.where(F.col("n_entity").between(MIN_SUPPORT, n_docs / 2**MIN_BITS))
    held = staged.write(entities.join(alone, "entity"), "held")
    frequency = staged.write(_frequency(known, n_docs, staged), "frequency")
    terms = staged.write(
        units.join(held.select("doc_id", "unit").distinct(), ["doc_id", "unit"], "left_semi")
        .select("doc_id", "unit", F.explode(_words(_blanked(F.col("text")))).alias("term"))
        .join(frequency, "term")
        .distinct(),
        "terms",
    )
    _, some_held = _classes(held, "entity", "n_entity")
    members, some_terms = _classes(terms, "term", "n_term")
    some_held, members, some_terms = (
        staged.write(x, name) for x, name in ((some_held, "some_held"), (members, "members"), (some_terms, "some_terms"))
    )
    both = _in_one_unit(some_held, some_terms).where(F.col("n_entity") >= MIN_SHARE * F.col("n_term"))
    both = both.select("doc_id", "entity", "term", "n_entity", "n_term")
    scored = staged.write(
        (both if scope == "text" else both.distinct())
        .groupBy("entity", "term", "n_entity", "n_term")
        .agg(F.count(F.lit(1)).alias("n_both"))
        .withColumn("bits", F.log2(F.lit(float(n_docs)) * F.col("n_both") / (F.col("n_entity") * F.col("n_term"))))
        .where((F.col("n_both") >= MIN_SUPPORT) & (F.col("n_both") >= MIN_SHARE * F.col("n_term")) & (F.col("bits") >= MIN_BITS))
        .select("entity", "term", "bits"),
        "scored",
    )
    if scope == "text":
        least = scored.select(F.col("term").alias("least")).distinct()
        telling = staged.write(members.join(least, "least", "left_semi").select("term"), "telling")
        return (
            known.select("doc_id", F.lit(0).alias("unit"), F.explode(_words(F.col("text"))).alias("term"))
            .join(telling, "term", "left_semi")
            .select("doc_id", "unit", "term")
            .distinct()
        )
    marked = (
        some_held.select("doc_id", "unit", "entity")
        .join(scored, "entity")
        .join(some_terms.select("doc_id", "unit", "term"), ["doc_id", "unit", "term"], "left_semi")
        .select("doc_id", "unit", F.col("term").alias("least"))
        .distinct()
    )
    return marked.join(members, "least").select("doc_id", "unit", "term")


def scan_pii(docs: DataFrame, scope: str = "line") -> DataFrame:
    """Per row of ``docs``: doc_id, the spans of each kind and the ``term`` spans, each sorted by start."""
    staged = Staged(docs.sparkSession, "pii")
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = [base_spans(F.col("text"), kind).alias(kind) for kind in KINDS]
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    marked = disclosing_terms(own, staged, scope).groupBy("doc_id", "unit").agg(F.collect_set("term").alias("terms"))
    if scope == "text":
        marked = marked.select(F.col("doc_id").alias("term_id"), "terms")
        term = F.when(F.col("terms").isNotNull(), _term_places(F.col("text"), F.col("terms"))).otherwise(nothing)
        return own.join(marked, F.col("doc_id") == F.col("term_id"), "left").select("doc_id", *base, term.alias("term"))
    terms = (
        _units(own, scope)
        .join(marked, ["doc_id", "unit"])
        .select("doc_id", "offset", F.explode(_term_places(F.col("text"), F.col("terms"))).alias("w"))
        .select("doc_id", (F.col("offset") + F.col("w.start")).alias("start"), (F.col("offset") + F.col("w.end")).alias("end"))
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("term"))
        .withColumnRenamed("doc_id", "term_id")
    )
    return (
        own.select("doc_id", *base)
        .join(terms, F.col("doc_id") == F.col("term_id"), "left")
        .select("doc_id", *KINDS, F.coalesce("term", nothing).alias("term"))
    )


def digest(spans: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and the list of all spans."""
    base = F.concat(*[_rendered(kind, F.col(kind)) for kind in KINDS])
    return spans.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _rendered("term", F.col("term"))), ",").alias("spans"),
        F.size("term").cast("long").alias("n_term"),
    )


def redact(text: Column, kinds: tuple[str, ...] = (*KINDS, "term")) -> Column:
    """The text with base values generalised to ``[KIND]`` and disclosing terms removed.

    Reads the span columns of ``scan_pii`` beside the text. Of overlapping
    spans the one that starts first is replaced, and the rest of the others.
    """
    marked = F.array_sort(F.concat(*[_replaced(kind, F.col(kind)) for kind in kinds]))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    return F.aggregate(
        marked,
        start,
        lambda a, p: F.struct(
            F.greatest(a["at"], p["end"]).alias("at"),
            F.concat(
                a["parts"],
                F.array(F.substring(text, a["at"] + 1, F.greatest(p["start"] - a["at"], F.lit(0))), p["mark"]),
            ).alias("parts"),
        ),
        lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, a["at"] + 1, F.length(text))),
    )
