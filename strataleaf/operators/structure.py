"""Section trees: block types, parents, labels, paths, appendix numbers, subtree sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import cyrillic_to_latin, has_cyrillic
from .graph import written

# Levels and label abbreviations of section types.
LEVELS = {"appendix": 1, "part": 2, "section": 3, "chapter": 4, "article": 5, "clause": 6}
ABBREVIATIONS = {
    "appendix": "app", "part": "pt", "section": "sec", "chapter": "ch", "article": "art", "clause": "cl", "subclause": "sc",
    "item": "it", "paragraph": "p", "table": "tb", "footnote": "fn", "title": "ti", "form": "fo", "body": "bo",
    "number": "no", "place_date": "pd", "signature": "sg", "note": "nt", "pdf_page": "pg",
}
LEAF = 99
# Class prefixes and what they stand for, first match wins; types that end the running text.
CLASSES = (
    ("APPL_BANNER", "appendix"), ("ACT_TITLE_APPL", "title"), ("ACT_TITLE", "title"), ("ACT_FORM", "form"), ("ACCEPTING_BODY", "body"),
    ("ACT_ESSENTIAL_ELEMENTS_NUM", "number"), ("ACT_ESSENTIAL_ELEMENTS", "place_date"), ("SIGNATURE", "signature"), ("DEPARTMENTAL", "note"),
    ("TEXT_CENTER", "note"), ("FOOTNOTE", "footnote"), ("TEXT_HEADER", "chapter"),
)
RESETS = ("form", "body", "number", "place_date", "signature")
# Words of headings, without apostrophes, those that follow the number and those that come before it.
AFTER = {"modda": "article", "модда": "article", "bob": "chapter", "боб": "chapter", "bolim": "section", "бўлим": "section", "қисм": "part", "qism": "part"}
BEFORE = {"modda": "article", "модда": "article"}
BEFORE_RU = {"статья": "article", "глава": "chapter", "раздел": "section", "часть": "part"}
NUMBER, NUMBER_RU, END = r"(\d+(?:[-–]\d+)?|[IVXLC]+)", r"(\d+(?:[-–.]\d+)?|[IVXLC]+)", r"(?:[^\p{L}\p{N}_].*)?$"
WORD_AFTER = "(" + "|".join(AFTER).replace("bolim", "bo[ʻʼ’‘`']?lim") + ")"
HEADINGS = (
    (rf"(?isu)^{NUMBER}\s*[-–]?\s*{WORD_AFTER}{END}", 1, 2, AFTER),
    (rf"(?isu)^({'|'.join(BEFORE)})\s+(\d+(?:[-–]\d+)?){END}", 2, 1, BEFORE),
    (rf"(?isu)^({'|'.join(BEFORE_RU)})\s+{NUMBER_RU}{END}", 2, 1, BEFORE_RU),
)
# Numbered headings, clauses, items, numbers of appendices; how long a heading may be.
HEAD, CLAUSE, ITEM, SHORT = r"(?s)^([IVXLC]+|\d+)[.)]\s+\S.*", r"(?s)^(\d+(?:\.\d+)*)[.)](?:\s+\S.*|\s*)$", r"(?isu)^\(?([a-zа-яўқғҳ]|\d+)\)\s+\S.*", 300
APPENDIX_AFTER, APPENDIX_BEFORE = r"(?isu)(\d+)\s*[-–]?\s*(?:илова|ilova|приложение)", r"(?isu)(?:илова|ilova|приложение|appendix|annex)\s*(?:№|n[o.]?|raqam)?\s*(\d+)"


def _any_starts(classes: Column, prefix: str) -> Column:
    return F.exists(classes, lambda c: c.startswith(prefix))


def classify(text: Column, classes: Column | None = None, table_share: Column | None = None) -> dict[str, Column]:
    """section_type, number and level of a text block by its classes (an array), its table, and its first words.

    A class decides before the words do, but for headers, whose words may name another heading. A table
    decides where it holds half of the text or more.
    """
    classes = classes if classes is not None else F.array().cast("array<string>")
    css = F
    for prefix, kind in CLASSES:
        css = css.when(_any_starts(classes, prefix), kind)
    css = css.when(table_share >= 0.5, "table") if table_share is not None else css
    css = css.otherwise("")
    header = _any_starts(classes, "TEXT_HEADER")
    leaf = (css != "") & (css != "chapter") & (css != "appendix")
    got = lambda p, k=1: F.regexp_extract(text, p, k)
    appendix = F.coalesce(F.nullif(got(APPENDIX_AFTER), F.lit("")), F.nullif(got(APPENDIX_BEFORE), F.lit("")), F.lit(""))
    rows = [(css == "appendix", F.lit("appendix"), appendix), (leaf, css, F.lit(""))]
    short = header | (F.length(text) <= SHORT)
    for pattern, number, word, types in HEADINGS:
        key = F.translate(F.lower(got(pattern, word)), "ʻʼ’‘`'", "")
        rows.append((short & text.rlike(pattern), F.create_map(*[F.lit(x) for pair in types.items() for x in pair])[key], got(pattern, number)))
    clause = got(CLAUSE)
    depth = F.length(clause) - F.length(F.replace(clause, F.lit("."))) + 1
    rows += [
        ((css == "chapter") | header, F.lit("chapter"), got(HEAD)),
        ((clause != "") & (depth == 1), F.lit("clause"), clause), (clause != "", F.lit("subclause"), clause),
        (text.rlike(ITEM), F.lit("item"), got(ITEM)),
    ]
    kind = num = F
    for when, name, n in rows:
        kind, num = kind.when(when, name), num.when(when, n)
    kind = kind.otherwise("paragraph")
    level = F.when(kind == "subclause", F.lit(LEVELS["clause"]) + depth - 1)
    for name, value in LEVELS.items():
        level = level.when(kind == name, value)
    return {"section_type": kind, "number": num.otherwise(""), "level": level.otherwise(LEAF).cast("long")}


def deepest(text: Column) -> Column:
    """A level that classify's containers do not pass, by the dots of a clause's number alone."""
    clause = F.regexp_extract(text, CLAUSE, 1)
    return F.coalesce(F.lit(LEVELS["clause"]) + F.length(clause) - F.length(F.replace(clause, F.lit("."))), F.lit(LEVELS["clause"]))


def parents(df: DataFrame, key: str, order: str, level: str, reset: Column, levels: int | None = None) -> DataFrame:
    """parent_order: the nearest earlier container of a smaller level since the last reset.

    Levels are few, so each contributes the last row it had as one running column; leaves
    (level 99) hang below the last container of any level. How many levels there are is looked up
    unless it is told; a deeper container than told is an error of the caller's.
    """
    if levels is None:
        levels = df.agg(F.max(F.when(F.col(level) < LEAF, F.col(level))).alias("n")).first().n or 1
    w = Window.partitionBy(key).orderBy(order)
    epochs = df.withColumn("__epoch", F.sum(reset.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    before = Window.partitionBy(key, "__epoch").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    last = [F.max(F.when((F.col(level) == k) & ~reset, F.col(order))).over(before) for k in range(1, levels + 1)]
    # A container closes all deeper ones, so the parent is the latest among the smaller levels.
    above = [F.when(F.col(level) > k, x) for k, x in enumerate(last, 1)]
    above += above[:1]  # greatest() wants two
    parent = F.when(~reset, F.greatest(*above))
    return epochs.withColumn("parent_order", parent).drop("__epoch")


def labels(df: DataFrame, key: str, parent: str, order: str, kind: str, number: str) -> DataFrame:
    """Label among siblings: abbreviation and number in Latin letters, or place among all siblings; later twins get _2, _3.

    Labels of one parent are told apart even where a twin's label is another's natural one: a twin that meets
    one is numbered on.
    """
    abbreviation = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])[F.col(kind)]
    seq = F.row_number().over(Window.partitionBy(key, parent).orderBy(order)).cast("string")
    latin = F.when(has_cyrillic(F.col(number)), cyrillic_to_latin(F.col(number))).otherwise(F.lower(F.col(number)))
    bare = F.regexp_replace(F.regexp_replace(latin, "[^A-Za-z0-9_]+", "_"), "^_+|_+$", "")
    base = F.when(F.col(number) == "", F.concat(abbreviation, seq)).otherwise(F.concat(abbreviation, F.lit("_"), F.when(bare == "", "x").otherwise(bare)))
    siblings = F.collect_list("__base").over(Window.partitionBy(key, parent).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    twin = F.row_number().over(Window.partitionBy(key, parent, "__base").orderBy(order))
    rows = df.withColumn("__base", base).withColumn("__twin", twin)
    # Only twins look at their siblings, to number past those whose own label is theirs.
    taken = F.when(F.col("__twin") > 1, siblings)
    free = F.filter(F.sequence(F.lit(2), F.size("__before") + 2), lambda k: ~F.array_contains("__before", F.concat("__base", F.lit("_"), k.cast("string"))))
    name = F.when(F.col("__twin") == 1, F.col("__base")).otherwise(F.concat("__base", F.lit("_"), F.element_at(free, F.col("__twin") - 1).cast("string")))
    return rows.withColumn("__before", taken).withColumn("label", name).drop("__base", "__twin", "__before")


def paths(df: DataFrame, key: str, order: str, parent: str, label: str) -> DataFrame:
    """path and depth by doubling: each round joins a row to the ancestor its path begins below, until all begin at a root."""
    rows = df.select(F.col(key).alias("__k"), F.col(order).alias("__o"), F.col(parent).alias("__up"), F.col(label).alias("path"), F.lit(1).alias("depth"))
    rows = written(rows, "paths")
    while not rows.where("__up IS NOT NULL").isEmpty():
        up = rows.select(F.col("__k"), F.col("__o").alias("__up"), F.col("__up").alias("__next"), F.col("path").alias("__path"), F.col("depth").alias("__depth"))
        rows = written(
            rows.join(up, ["__k", "__up"], "left").select(
                "__k", "__o", F.col("__next").alias("__up"), F.when(F.col("__path").isNotNull(), F.concat("__path", F.lit("."), "path")).otherwise(F.col("path")).alias("path"), (F.col("depth") + F.coalesce("__depth", F.lit(0))).alias("depth")
            ),
            "paths",
        )
    return df.join(rows.select(F.col("__k").alias(key), F.col("__o").alias(order), "path", "depth"), [key, order])


def below(path: Column, top: str) -> Column:
    """Whether a path is top or below it."""
    return (path == top) | path.startswith(top + ".")


def with_appendix_numbers(df: DataFrame, key: str, order: str, number: str) -> DataFrame:
    """appendix_number by the running count of unnumbered rows and the greatest lead of a number over it."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counted = df.withColumn("__c", F.sum(F.when(F.col(number).isNull(), 1).otherwise(0)).over(w))
    lead = F.greatest(F.lit(0), F.coalesce(F.max(F.col(number) - F.col("__c")).over(w), F.lit(0)))
    return counted.withColumn("appendix_number", F.coalesce(F.col(number), (F.col("__c") + lead)).cast("long")).drop("__c")


def subtree_sums(df: DataFrame, key: str, order: str, path: str, value: str) -> DataFrame:
    """Sum of value over each row and all below: every row counts for each prefix of its path."""
    parts = F.split(path, r"\.")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "."))
    sums = df.select(key, F.explode(prefixes).alias(path), value).groupBy(key, path).agg(F.sum(value).alias("subtree"))
    return df.join(sums, [key, path])
