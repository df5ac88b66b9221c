"""Personal data: fixed patterns, and terms that give a protected entity away.

Base spans come from regular expressions in generated code. ``split`` gives the gaps between
the matches and ``regexp_extract_all`` the matches, so a running sum of their lengths gives
code point offsets. The patterns use possessive loops and look behind for a run's beginning:
the matches are the same, and no text makes them recurse or take quadratic time.

Terms: an entity is a value found (an address, a number), and the unit of co-occurrence is a
document with a text of its own, over the whole corpus. Whoever reads term t knows entity e
with probability p(e|t); what counts is the lower end of its Wilson interval, ``CHANCE`` being
the square of the normal quantile. t discloses e if that end is at least ``DISCLOSES`` (at most
one bit about e is left) and ``GAIN`` times the share of documents with e (five bits are
gained). So three documents are the least evidence at any size of the corpus, and a word that
is independent of all entities is taken for a term with probability below the number of
entities in a document over 4,096, as a rule far below.

A disclosing term is generalised at every occurrence in the corpus, also in documents that
don't name e, and removed from ``REVEALS`` on. Terms are words of any characters, such as
handles and account numbers, without marks at their ends, but for words that overlap a base
span. Names of several words are found by any of their words. Near copies of a document count
as documents, exact copies don't; the pipeline removes near copies first.

Entities that occur in the same documents are one class, and so are terms, so pairs are made
of classes: a page that lists 10,000 values and words makes few of them.

Defined results
* A null text counts as empty and has no spans. A null doc_id is kept.
* Rows are told apart by doc_id and the text's hash; repeated rows have the same result.
* An empty table gives an empty result. ``sanitised`` keeps all other columns, sets n_chars
  of changed texts, if there is such a column, and leaves a null text null.
* Base spans of different kinds may overlap; in sanitised text they are masked together.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from epiframe.llm.common import WORD, compact, query, same, small, table

DISCLOSES = 0.5
REVEALS = 0.9
CHANCE = 3.0
GAIN = 32
#: Rounding at the threshold itself.
SLACK = 1e-9
#: Words in a row while terms are looked for.
RUN = 128
#: Code points in a piece of a text that is cut at spans.
PIECE = 4096

KINDS = ["email", "ip", "card", "phone", "term"]
TERM = KINDS.index("term")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Every text with a match has one of these.
MAYBE = r"@|[0-9]\.[0-9]|\+[0-9]|[0-9](?:[\x20-]?[0-9]){15}"
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
EDGES = r"""^[.,;:!?()\[\]{}"'<>|*$%&#-]+|[.,;:!?()\[\]{}"'<>|*$%&#-]+$"""


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i):  # the i-th digit from the right, from 0
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + value(i))
    return total % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == 1, match.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
        .when(kind == 2, F.when(n.between(16, 19), luhn(digits)).otherwise(False))
        .when(kind == 3, n.between(8, 15))
        .otherwise(True)
    )


def matches(text: Column, pattern: str) -> Column:
    """Array of (gap, m): each match with the text since the one before; the last m is null."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("m"))


def located(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds start and end to rows with pos, gap_length and m_length; all but those are keys."""
    before = W.partitionBy(*keys).orderBy("pos")
    end = F.sum(F.col("gap_length") + F.col("m_length")).over(before)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("m_length"))


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"))


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, th, kind, start, end of the valid matches, once for repeated rows."""
    kinds = F.array(
        *[
            F.struct(F.lit(i).alias("kind"), matches(F.col("text"), PATTERNS[k]).alias("found"))
            for i, k in enumerate(KINDS[:TERM])
        ]
    )
    rows = keyed(docs).filter(F.col("text").rlike(MAYBE)).select("doc_id", "th", F.inline(kinds))
    # the array of matches is a column of its own, so its rows don't carry it along
    rows = rows.filter(F.size("found") > 1).select("doc_id", "th", "kind", F.posexplode("found").alias("pos", "f"))
    rows = rows.filter("f.m IS NOT NULL")
    rows = rows.select(
        "doc_id", "th", "kind", "pos",
        F.length("f.gap").cast("long").alias("gap_length"),
        F.length("f.m").cast("long").alias("m_length"),
        valid(F.col("kind"), F.col("f.m")).alias("ok"),
    ).dropDuplicates(["doc_id", "th", "kind", "pos"])
    return located(rows, ["doc_id", "th", "kind"]).filter("ok").select("doc_id", "th", "kind", "start", "end")


def entities(text: Column, i: int) -> Column:
    """The valid values of a kind in normal form, after the kind's name."""
    values = F.regexp_extract_all(text, F.lit(PATTERNS[KINDS[i]]), F.lit(0))
    values = F.filter(values, lambda m: valid(F.lit(i), m))

    def plain(m):
        return F.lower(m) if i < 2 else F.regexp_replace(m, "[^0-9]", "")

    return F.transform(values, lambda m: F.concat(F.lit(KINDS[i] + ":"), plain(m)))


def free_terms(text: Column) -> Column:
    """Distinct lower-case words of any characters that overlap no valid base span."""

    def words(t):
        return F.regexp_extract_all(t, F.lit(WORD), F.lit(0))

    def hidden(i):  # spaces stay, so the words keep their places
        found = matches(text, PATTERNS[KINDS[i]])

        def part(x):
            m = F.when(valid(F.lit(i), x["m"]), F.regexp_replace(x["m"], r"[^\x20]", "\uE000")).otherwise(x["m"])
            return F.concat(x["gap"], F.coalesce(m, F.lit("")))

        return F.array_join(F.transform(found, part), "")

    both = F.arrays_zip(words(text).alias("w"), *[words(hidden(i)).alias(f"h{i}") for i in range(TERM)])

    def same_in_all(x):
        ok = x["w"] == x["h0"]
        for i in range(1, TERM):
            ok = ok & (x["w"] == x[f"h{i}"])
        return ok

    left = F.transform(F.filter(both, same_in_all), lambda x: x["w"])
    free = F.when(text.rlike(MAYBE), left).otherwise(words(text))
    return F.array_distinct(F.filter(F.transform(free, term), lambda w: w != ""))


def term(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), EDGES, "")


def entity_docs(docs: DataFrame) -> DataFrame:
    """Distinct documents with entities: th, entities, terms."""
    rows = keyed(docs).filter(F.col("text").rlike(MAYBE))
    found = F.array_distinct(F.concat(*[entities(F.col("text"), i) for i in range(TERM)]))
    rows = rows.select("th", "text", found.alias("entities")).filter(F.size("entities") > 0)
    return rows.select("th", "entities", free_terms(F.col("text")).alias("terms")).dropDuplicates(["th"])


def least_documents(discloses: float) -> int:
    """Documents that a term has to share with an entity if it occurs in no others."""
    n = 1
    while n / (n + CHANCE) < discloses - SLACK:
        n += 1
    return n


def sure(both: Column, of: Column) -> Column:
    """The lower end of the Wilson interval for a share of ``both`` out of ``of``."""
    p = both / of
    spread = F.sqrt(CHANCE * (p * (1 - p) / of + CHANCE / (4 * of * of)))
    return (p + CHANCE / (2 * of) - spread) / (1 + CHANCE / of)


def classed(rows: DataFrame, name: str, least: int) -> tuple[DataFrame, DataFrame]:
    """(members, places): values with their class, and (th, class, n) of each class, from
    distinct (th, value). A class has the same n documents, told by two hashes over them."""
    marks = F.count(F.lit(1)).alias("n"), F.bit_xor("th").alias("a"), F.bit_xor(F.xxhash64("th")).alias("b")
    members = rows.groupBy(name).agg(*marks).filter(F.col("n") >= least)
    members = compact(members.select(name, "n", F.xxhash64("n", "a", "b").alias("class")))
    first = members.groupBy("class", "n").agg(F.min(name).alias(name))
    return members, rows.join(first, name).select("th", "class", "n")


def term_risks(docs: DataFrame, discloses: float) -> tuple[DataFrame, DataFrame] | None:
    """(term, share) of the terms that give some entity away, and (th, term) of all documents
    with them; None if there are none."""
    least = least_documents(discloses)
    known = compact(entity_docs(docs))
    named, named_in = classed(known.select("th", F.explode("entities").alias("entity")), "entity", least)
    if named.isEmpty():
        return None
    words, words_in = classed(known.select("th", F.explode("terms").alias("term")), "term", least)
    pairs = named_in.select("th", F.col("class").alias("e"), F.col("n").alias("n_e"))
    pairs = pairs.join(words_in, "th").groupBy("e", "n_e", "class", "n").agg(F.count(F.lit(1)).alias("n_te"))
    # documents with entities are some of all documents, so their counts bound the share from above
    pairs = pairs.filter(sure(F.col("n_te"), F.col("n")) >= discloses - SLACK)
    pairs = compact(pairs.select("class", "n_e", "n_te").distinct())
    if pairs.isEmpty():
        return None
    likely = compact(words.join(pairs, "class").select("term", "n_e", "n_te"))
    wanted = compact(likely.select(F.xxhash64("term").alias("h")).distinct())
    seen = keyed(docs).select("th", F.explode(free_terms(F.col("text"))).alias("term"))
    seen = seen.withColumn("h", F.xxhash64("term")).join(small(wanted), "h", "left_semi")
    seen = compact(seen.select("th", "term").distinct())
    total = keyed(docs).select("th").distinct().count()
    share = sure(F.col("n_te"), F.col("n_t"))
    risk = likely.join(seen.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")), "term").withColumn("share", share)
    tells = (F.col("share") >= discloses - SLACK) & (F.col("share") * total >= GAIN * F.col("n_e"))
    risk = compact(risk.filter(tells).groupBy("term").agg(F.max("share").alias("share")))
    return None if risk.isEmpty() else (risk, seen)


def term_spans(docs: DataFrame, risk: DataFrame, seen: DataFrame) -> DataFrame:
    """doc_id, th, kind, start, end, share of the disclosing terms, once for repeated rows.

    Documents with terms are unfolded into runs of ``RUN`` words; only words that are terms
    become rows.
    """
    told = compact(seen.join(risk, "term"))
    there = small(compact(told.select("th").distinct()))
    per = told.groupBy("th").agg(F.collect_set("term").alias("terms"))
    rows = keyed(docs).join(there, "th", "left_semi").dropDuplicates(["doc_id", "th"]).join(per, "th")
    rows = rows.select("doc_id", "th", "terms", matches(F.col("text"), WORD).alias("f"))
    each = F.sequence(F.lit(0), F.floor((F.size("f") - 1) / RUN).cast("int"))
    rows = rows.select("doc_id", "th", "terms", F.posexplode(F.transform(each, lambda k: F.slice("f", k * RUN + 1, RUN))).alias("run", "f"))

    def length(f):
        return F.aggregate(f, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.coalesce(F.length(x["m"]), F.lit(0))).cast("long")

    hits = F.filter(
        F.transform("f", lambda x, i: F.struct(i.alias("i"), F.length(x["m"]).alias("n"), term(x["m"]).alias("term"))),
        lambda x: F.coalesce(F.array_contains("terms", x["term"]), F.lit(False)),
    )
    rows = rows.withColumns({"n": length(F.col("f")), "hits": hits})
    rows = rows.withColumn("first", F.sum("n").over(W.partitionBy("doc_id", "th").orderBy("run")) - F.col("n"))
    rows = rows.filter(F.size("hits") > 0)
    ends = F.transform("hits", lambda x: F.struct(length(F.slice("f", 1, x["i"] + 1)).alias("end"), x["n"].alias("n"), x["term"].alias("term")))
    words = rows.select("doc_id", "th", "first", F.inline(ends))
    end = F.col("first") + F.col("end")
    words = words.select("doc_id", "th", (end - F.col("n")).alias("start"), end.alias("end"), "term").join(risk, "term")
    return words.select("doc_id", "th", F.lit(TERM).alias("kind"), "start", "end", "share")


def all_spans(docs: DataFrame, discloses: float = DISCLOSES) -> DataFrame:
    """doc_id, th, kind (place in KINDS), start, end, share (null for base spans)."""
    spans = base_spans(docs).withColumn("share", F.lit(None).cast("double"))
    found = term_risks(docs, discloses)
    return compact(spans if found is None else spans.unionByName(term_spans(docs, *found)))


def on_key(a: str, b: str) -> Column:
    return same(F.col(f"{a}.doc_id"), F.col(f"{b}.doc_id")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))


def findings(docs: DataFrame, discloses: float = DISCLOSES) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans."""
    spans = all_spans(docs, discloses).groupBy("doc_id", "th")
    spans = spans.agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("s")).alias("f")
    rows = keyed(docs).select("doc_id", "th").alias("d").join(spans, on_key("d", "f"), "left")
    s = F.coalesce("f.s", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>"))
    names = F.array(*map(F.lit, KINDS))

    def written(s):
        return F.array_join(
            F.transform(s, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))), ","
        )

    def number(i):
        return F.size(F.filter(s, lambda x: x["kind"] == i)).cast("long")

    base = F.filter(s, lambda x: x["kind"] < TERM)
    return rows.select(
        "d.doc_id",
        *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(s).alias("spans"),
    )


def masks(spans: DataFrame, reveals: float = REVEALS) -> DataFrame:
    """doc_id, th, cuts: sorted (after, start, end, label); spans that overlap become one."""
    key = ["doc_id", "th"]
    order = W.partitionBy(*key).orderBy("start", "end", "kind")
    upto = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.when(F.col("start") >= F.coalesce(upto, F.lit(0)), 1).otherwise(0)
    rows = spans.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(order))
    label = F.when(F.col("kind") < TERM, F.concat(F.lit("<"), F.array(*map(F.lit, KINDS))[F.col("kind")], F.lit(">")))
    label = label.otherwise(F.when(F.col("share") < reveals, "<term>").otherwise(""))
    rows = rows.groupBy(*key, "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by(label, "kind").alias("label")
    )
    after = F.lag("end", 1, 0).over(W.partitionBy(*key).orderBy("start"))
    rows = rows.withColumn("after", after).groupBy(*key)
    return rows.agg(F.sort_array(F.collect_list(F.struct("start", "end", "after", "label"))).alias("cuts"))


def between(pieces: Column, start: Column, end: Column) -> Column:
    """The code points from start to end of a text cut into pieces of PIECE."""
    i, j = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
    a, z = (start % PIECE).cast("int"), (end % PIECE).cast("int")

    def piece(k):
        return F.coalesce(F.get(pieces, k), F.lit(""))

    apart = F.concat(
        F.substr(piece(i), a + 1),
        F.array_join(F.slice(pieces, i + 2, F.greatest(j - i - 1, F.lit(0))), ""),
        F.substr(piece(j), F.lit(1), z),
    )
    return F.when(i == j, F.substr(piece(i), a + 1, z - a)).otherwise(apart)


def sanitised(docs: DataFrame, discloses: float = DISCLOSES, reveals: float = REVEALS) -> DataFrame:
    """The documents with all their columns, spans in the text replaced by labels."""
    cuts = compact(masks(all_spans(docs, discloses), reveals))
    there = small(compact(cuts.select(F.col("th").alias("_th")).distinct()))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(row, "doc_id", th.alias("th"))
    others = rows.join(there, rows["th"] == there["_th"], "left_anti").select("row.*")
    rows = rows.join(there, rows["th"] == there["_th"], "left_semi").alias("d")
    rows = rows.join(cuts.alias("f"), on_key("d", "f"), "left")
    pieces = F.regexp_extract_all(F.col("row.text"), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    rows = rows.select("row", "f.cuts", F.when(F.col("f.cuts").isNotNull(), pieces).alias("pieces"))
    text, cut = F.col("pieces"), F.col("cuts")
    parts = F.transform(cut, lambda x: F.concat(between(text, x["after"], x["start"]), x["label"]))
    last = F.element_at(cut, -1)["end"]
    rest = between(text, last, F.length("row.text").cast("long"))
    new = F.when(cut.isNotNull(), F.concat(F.array_join(parts, ""), rest)).otherwise(F.col("row.text"))
    rows = rows.select("row", cut.isNotNull().alias("changed"), new.alias("new"))
    out = []
    for c in docs.columns:
        old = F.col(f"row.`{c}`")
        if c == "text":
            old = F.col("new")
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            old = F.when(F.col("changed"), F.length("new").cast(kind)).otherwise(old)
        out.append(old.alias(c))
    return others.unionByName(rows.select(*out))


# -- the same in SQL, with the patterns as they are meant, for an engine without backtracking --

_SQL_PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    r"[0-9](?:[\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
_SQL_KINDS = ", ".join(f"({i}, '{KINDS[i]}', '{p}')" for i, p in enumerate(_SQL_PATTERNS))
_SQL_VALID = rf"""CASE kind WHEN 0 THEN true WHEN 1 THEN regexp_full_match(m, '{BYTE}(?:\.{BYTE}){{3}}')
  WHEN 2 THEN length(g) BETWEEN 16 AND 19 AND list_sum(list_transform(range(length(g)), lambda i:
    CASE WHEN i % 2 = 0 THEN substr(g, length(g) - i, 1)::INTEGER
    ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr(g, length(g) - i, 1)::INTEGER + 1] END)) % 10 = 0
  ELSE length(g) BETWEEN 8 AND 15 END"""
_SQL_EDGES = EDGES.replace("'", "''")


def _sql_found(name: str, source: str, key: str) -> str:
    """CTEs with the valid matches of each kind in ``text``: {name}(key, kind, s, e, m, g)."""
    return rf"""{name}0 AS (SELECT {key}, kind, regexp_extract_all(text, p) AS ms, string_split_regex(text, p) AS gaps
  FROM {source}, kinds WHERE regexp_matches(text, p)),
{name}1 AS (SELECT {key}, kind, unnest(range(1, len(ms) + 1)) AS i, ms, gaps FROM {name}0),
{name}2 AS (SELECT {key}, kind, ms[i] AS m, regexp_replace(ms[i], '[^0-9]', '', 'g') AS g,
  sum(length(gaps[i]) + length(ms[i])) OVER (PARTITION BY {key}, kind ORDER BY i)::BIGINT AS e FROM {name}1),
{name} AS (SELECT {key}, kind, e - length(m) AS s, e, m, g FROM {name}2 WHERE {_SQL_VALID})"""


_SQL_SURE = f"(n_te / n_t + {CHANCE} / (2 * n_t) - sqrt({CHANCE} * (n_te / n_t * (1 - n_te / n_t) / n_t + {CHANCE} / (4 * n_t * n_t)))) / (1 + {CHANCE} / n_t)"
FINDINGS_SQL = rf"""WITH kinds(kind, name, p) AS (VALUES {_SQL_KINDS}),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
x AS (SELECT text, row_number() OVER () AS x FROM (SELECT DISTINCT text FROM d)),
{_sql_found("base", "x", "x")},
w0 AS (SELECT x, regexp_extract_all(text, '{WORD}') AS ms, string_split_regex(text, '{WORD}') AS gaps FROM x),
w1 AS (SELECT x, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap, unnest(range(1, len(ms) + 1)) AS i FROM w0),
w AS (SELECT x, i, regexp_replace(lower(m), '{_SQL_EDGES}', '', 'g') AS term, length(m) AS n,
  sum(length(gap) + length(m)) OVER (PARTITION BY x ORDER BY i)::BIGINT AS e FROM w1),
hit AS (SELECT DISTINCT w.x, i FROM w JOIN base b ON b.x = w.x AND b.s < w.e AND b.e > w.e - w.n),
xt AS (SELECT DISTINCT x, term FROM w ANTI JOIN hit USING (x, i) WHERE term <> ''),
ent AS (SELECT DISTINCT x, kind || ':' || CASE WHEN kind < 2 THEN lower(m) ELSE g END AS entity FROM base),
ne AS (SELECT entity, count(*) AS n_e FROM ent GROUP BY 1),
nt AS (SELECT term, count(*)::DOUBLE AS n_t FROM xt GROUP BY 1),
te AS (SELECT n_e, term, count(*)::DOUBLE AS n_te FROM ent JOIN ne USING (entity) JOIN xt USING (x) GROUP BY entity, n_e, term),
risk AS (SELECT DISTINCT term FROM te JOIN nt USING (term) WHERE {_SQL_SURE} >= {DISCLOSES} - {SLACK}
  AND {_SQL_SURE} * (SELECT count(*) FROM x) >= {GAIN} * n_e),
spans AS (SELECT x, kind, s, e FROM base UNION ALL
  SELECT x, {TERM}, e - n, e FROM w JOIN (SELECT x, term FROM xt SEMI JOIN risk USING (term)) USING (x, term)),
named AS (SELECT x, kind, s, [{", ".join(f"'{k}'" for k in KINDS)}][kind + 1] || ':' || s || ':' || e AS t FROM spans),
per AS (SELECT x.text, {", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, k in enumerate(KINDS))},
  sha256(coalesce(string_agg(t, ',' ORDER BY kind, s) FILTER (WHERE kind < {TERM}), '')) AS base_sha256,
  coalesce(string_agg(t, ',' ORDER BY kind, s), '') AS spans FROM x LEFT JOIN named USING (x) GROUP BY x.text)
SELECT doc_id, per.* EXCLUDE text FROM d JOIN per USING (text)"""


@query("op8_pii_sanitise", FINDINGS_SQL)
def op8_pii_sanitise(spark, sf_dir):
    return findings(table(spark, sf_dir, "documents"))
