"""Cards, passports, annotations and classification lines as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import to_date

# Names of classification systems; forms of codes, registry numbers and placeholders.
SYSTEMS = {"okoz": "okoz", "окоз": "okoz", "lqbl": "okoz", "tsz": "tsz", "тсз": "tsz", "tdl": "tsz"}
CODE, REGISTRY, PLACEHOLDER = r"^(\d{2}(?:\.\d{2}){3})\s", r"(?:^|[^\p{L}\p{N}_])(\d{2}/\d{2}/\d+/\d+)(?:[^\p{L}\p{N}_]|$)", r"(?iu)no description|тавсиф йўқ|нет описания|tavsif yo"
# What the labels of a card mean, and the order of a card's 21 cells.
LABELS = {
    "ҳужжаттури": "doc_type", "hujjatturi": "doc_type", "типдокумента": "doc_type", "видакта": "doc_type", "documenttype": "doc_type",
    "ҳужжатшакли": "doc_form", "hujjatshakli": "doc_form", "формадокумента": "doc_form", "documentform": "doc_form",
    "ҳужжаттили": "language", "hujjattili": "language", "языкдокумента": "language", "documentlanguage": "language",
    "ҳужжатҳолати": "status", "hujjatholati": "status", "статусдокумента": "status", "состояниедокумента": "status", "documentstatus": "status",
    "кучгакиришсанаси": "effective_from", "kuchgakirishsanasi": "effective_from", "датавступлениявсилу": "effective_from",
    "кучинийўқотгансанаси": "effective_to", "kuchiniyoqotgansanasi": "effective_to", "датаутратысилы": "effective_to",
    "кучинийўқотишсабаби": "lost_reason", "причинаутратысилы": "lost_reason", "амалқилишмуддати": "validity", "срокдействия": "validity",
    "меъёрийликхарактери": "normativity", "характернормативности": "normativity", "давлатрўйхатрақами": "state_reg_no", "давлатрўйхатиданўтгансанаси": "state_reg_date",
}
CELLS = (
    "name", "doc_type", "doc_form", "state_reg_no", "state_reg_date", "language", "moj_reg_no", "moj_reg_date", "status", "effective_from", "validity", "effective_to", "lost_reason",
    "normativity", "source", "source_edition_no", "source_published_at", "source_article", "source_permit_date", "used_for_effective", "developer",
)
# Words for a form of act; the line of requisites.
FORMS = (
    "қарори", "қарор", "қонуни", "қонун", "фармони", "фармон", "буйруғи", "буйруқ", "низоми", "низом", "qarori", "qaror", "qonuni", "qonun", "farmoni", "farmon",
    "buyrugʻi", "buyruq", "nizomi", "nizom", "постановление", "закон", "указ", "приказ", "распоряжение", "решение",
)
REQUISITES = r"(?iu)^(.+?),\s*(\d{2}\.\d{2}\.\d{4})\s*(?:йилдаги|yildagi|г\.?|от)?\s*(\S+?)(?:-(?:сон|son))?\s*$"


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def classifications(text: Column) -> Column:
    """array<struct<system, code, label>> of lines `[SYSTEM: 1. a / b; 2. c]`; the last part with a code gives it."""
    whole = F.regexp_extract_all(text, F.lit(r"(?s)\[\s*[^\]:\[]+?\s*:\s*.*?\]"), F.lit(0))

    def group(x: Column) -> Column:
        name = F.lower(F.trim(F.regexp_extract(x, r"(?s)^\[\s*([^\]:\[]+?)\s*:", 1)))
        body = F.trim(F.regexp_extract(x, r"(?s)^\[\s*[^\]:\[]+?\s*:\s*(.*?)\]$", 1))
        entries = F.transform(F.split(body, r";\s*(?=\d+\.\s)"), lambda e: F.regexp_replace(F.regexp_replace(e, r"^\s*\d+\.\s*", ""), r"^[ ;]+|[ ;]+$", ""))
        entries = F.filter(entries, lambda e: (e != "") & ~e.rlike(PLACEHOLDER))
        return F.transform(entries, lambda e: entry(F.coalesce(literal_map(SYSTEMS)[name], name), e))

    def entry(system: Column, e: Column) -> Column:
        items = F.filter(F.transform(F.split(e, " / "), lambda i: F.trim(i)), lambda i: i != "")
        codes = F.filter(F.transform(items, lambda i: F.regexp_extract(i, CODE, 1)), lambda c: c != "")
        return F.struct(system.alias("system"), F.coalesce(F.try_element_at(codes, F.lit(-1)), F.lit("")).alias("code"), F.array_join(items, " / ").alias("label"))

    return F.flatten(F.transform(whole, group))


def registry_number(text: Column) -> Column:
    return F.regexp_extract(text, REGISTRY, 1)


def passport(requisites: Column) -> dict[str, Column]:
    """authority, document_form, adopted_at and document_number of `WHO FORM, dd.mm.yyyy yildagi N-son`."""
    fits = requisites.rlike(REQUISITES)
    who = F.trim(F.regexp_extract(requisites, REQUISITES, 1))
    words = F.split(who, r"\s+")
    form = fits & (F.size(words) > 1) & F.lower(F.element_at(words, -1)).isin(*FORMS)
    return {
        "authority": F.when(form, F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " ")).when(fits, who).otherwise(""),
        "document_form": F.when(form, F.element_at(words, -1)).otherwise(""),
        "adopted_at": F.when(fits, to_date(F.regexp_extract(requisites, REQUISITES, 2))),
        "document_number": F.when(fits, F.regexp_extract(requisites, REQUISITES, 3)).otherwise(""),
    }


def card_fields(pairs: Column) -> Column:
    """map of field to value of a card's array<struct<label, value>> in order: by label, by place where there are all cells; the first wins."""
    whole, cells = F.size(pairs) == len(CELLS), F.array(*[F.lit(c) for c in CELLS])

    def named(pair: Column, at: Column) -> Column:
        key = F.regexp_replace(F.lower(pair["label"]), r"[^\p{L}\p{N}_]+", "")
        return F.struct(F.coalesce(literal_map(LABELS)[key], F.when(whole, F.try_element_at(cells, at + 1))).alias("name"), pair["value"].alias("value"))

    known = F.filter(F.transform(pairs, named), lambda x: x["name"].isNotNull())
    names = F.array_distinct(F.transform(known, lambda x: x["name"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(known, lambda x: x["name"] == n), 1)["value"]))
