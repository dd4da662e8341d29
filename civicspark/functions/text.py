"""String functions of the money and vote tables, as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SUFFIXES = ["jr", "sr", "ii", "iii", "iv"]
NAME_DROP = ["jr", "sr", "ii", "iii", "iv", "mr", "mrs", "ms", "dr"]
HONORIFICS = ["dr", "mr", "mrs", "ms", "mx", "rev", "reverend", "pastor", "fr", "father", "hon", "honorable", "prof", "professor", "sen", "senator", "rep", "representative", "ald", "alderman", "alderperson"]
GIVEN_NAMES = [
    ["william", "bill", "will"], ["robert", "bob", "rob"], ["james", "jim"], ["timothy", "tim", "timmy"], ["anthony", "tony"], ["michael", "mike"],
    ["thomas", "tom"], ["joseph", "joe"], ["daniel", "dan"], ["christopher", "chris"], ["edward", "ed"], ["kenneth", "ken"],
    ["charles", "chuck", "charlie"], ["elizabeth", "liz", "beth"], ["katherine", "kate", "katie"], ["patricia", "pat"], ["jennifer", "jen"],
]
ORGANISATION_TOKENS = ["inc.", "llc", "ltd", "corp", "pac", "union", "committee", "group"]
ORG_STOP = "pac committee fund friends of for the citizens inc llc llp co corp corporation union political action campaign ltd lp company assoc association group holdings".split()
ACRONYM_STOP = "of the for and a an pac committee fund friends citizens political action campaign".split()
TITLE_STOP = "a an the of to for and or in on re regarding amendment amend ordinance order resolution city chicago municipal code section sections chapter chapters title titles by adding new various as substitute year fiscal regarding et al v vs case cited no number".split()
TRUTHY = ["true", "t", "1", "y", "yes"]
BARE_ELECTIONS = ["2026-school-board", "2027-municipal"]
OFFICE_SLUGS = {"school_board_president": "school-board-president", "mayor": "mayor", "city_clerk": "city-clerk", "city_treasurer": "city-treasurer"}
OFFICE_CODES = {"school_board_president": "President", "mayor": "Mayor", "city_clerk": "Clerk", "city_treasurer": "Treasurer"}
OFFICE_LABELS = {"school_board_president": "Board President", "school_board_member": "School Board", "alderperson": "City Council", "mayor": "Mayor", "city_clerk": "City Clerk", "city_treasurer": "City Treasurer"}
CITYWIDE_ORDER = {"mayor": -4, "city-clerk": -3, "city-treasurer": -2}


def lookup(values: dict, key: Column, default: Column | None = None) -> Column:
    """The value of key in a small fixed table, else default (null)."""
    pairs = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    found = F.try_element_at(pairs, key)
    return found if default is None else F.coalesce(found, default)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def kebab(c: Column) -> Column:
    """Lower case, runs of other characters to one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug(c: Column, cap: int | None = 80) -> Column:
    """A stable key from a name. The cut at cap comes last, so a cut key may end in a hyphen."""
    return F.substring(kebab(c), 1, cap) if cap else kebab(c)


def norm(c: Column) -> Column:
    """Lower case, everything but letters and digits to single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]", " "), " +", " "))


@lru_cache(maxsize=2)
def _decomposed(ascii_only: bool) -> tuple[str, str, dict[str, str]]:
    """What compatibility decomposition without its marks makes of characters, by Python's own tables: characters with one
    in their place and that one, then those that go; and characters with several. ascii_only keeps ASCII of the
    result. Hangul syllables stay whole, else."""
    one, gone, many = {}, [], {}
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x30000)):
        ch = chr(code)
        plain = unicodedata.normalize("NFKD", ch)
        if ascii_only:
            if found := plain.encode("ascii", "ignore").decode():
                (one if len(found) == 1 else many)[ch] = found
        elif unicodedata.combining(ch):
            gone.append(ch)
        elif plain != ch and not 0xAC00 <= code <= 0xD7A3:
            found = "".join(x for x in plain if not unicodedata.combining(x))
            (one if len(found) == 1 else many)[ch] = found
    return "".join([*one, *gone]), "".join(one.values()), many


_BEYOND_ASCII = r"[^\x00-\x7F]"


def _plain_letters(c: Column, ascii_only: bool) -> Column:
    """c by the table of _decomposed(). Each character costs a look into a hash table at most, and those of ASCII alone
    not even that: a class of hundreds of characters in a pattern would be tried one by one at each place."""
    given, meant, many = _decomposed(ascii_only)
    one = F.translate(c, given, meant)

    def place(ch: Column, k: int) -> Column:
        """The k-th of the characters that ch stands for; those that stand for fewer go."""
        told = {x: y for x, y in many.items() if len(y) > k}
        return F.translate(ch, "".join([*told, *(x for x in many if x not in told)]), "".join(y[k] for y in told.values()))

    def spelled(ch: Column) -> Column:
        first = place(ch, 0)
        return F.when((F.ascii(ch) < 128) | (first == ch), ch).otherwise(F.concat(first, *[place(ch, k) for k in range(1, max(map(len, many.values())))]))

    pieces = F.regexp_extract_all(one, F.lit(rf"(?s)[\x00-\x7F]+|{_BEYOND_ASCII}"), F.lit(0))
    holds = one.rlike(_BEYOND_ASCII) & (F.translate(one, "".join(many), "") != one)
    return F.when(~c.rlike(_BEYOND_ASCII), c).when(holds, F.array_join(F.transform(pieces, spelled), "")).otherwise(one)


def fold(c: Column) -> Column:
    """Accents taken off, then what isn't ASCII dropped."""
    return F.regexp_replace(_plain_letters(c, True), f"{_BEYOND_ASCII}+", "")


def name_tokens(c: Column, drop: Sequence[str] = tuple(SUFFIXES)) -> Column:
    """Tokens of a folded name without suffixes and single letters, in order."""
    return F.filter(F.split(norm(c), " "), lambda t: (F.length(t) > 1) & ~t.isin(*drop))


def _letters(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(c), "[^a-z]+", " "), " "), lambda t: (F.length(t) > 1) & ~t.isin(*NAME_DROP))


def split_name(c: Column) -> Column:
    """struct(family, given): token arrays, distinct and sorted. "Last, First" if there is a comma, else the last token is the family."""
    c = F.coalesce(c, F.lit(""))
    comma, tokens = F.instr(c, ",") > 0, _letters(c)
    n = F.size(tokens)
    family = F.when(comma, _letters(F.substring_index(c, ",", 1))).otherwise(F.slice(tokens, F.greatest(n, F.lit(1)), 1))
    given = F.when(comma, _letters(F.regexp_replace(c, "^[^,]*,", ""))).otherwise(F.slice(tokens, F.lit(1), F.greatest(n - 1, F.lit(0))))
    return F.struct(F.array_sort(F.array_distinct(family)).alias("family"), F.array_sort(F.array_distinct(given)).alias("given"))


def canonical_given(tokens: Column) -> Column:
    """Each given name by the first spelling of its group in the closed table; distinct and sorted."""
    table = {spelling: group[0] for group in GIVEN_NAMES for spelling in group}
    return F.array_sort(F.array_distinct(F.transform(tokens, lambda t: lookup(table, t, t))))


def payer_name(last: Column, first: Column) -> Column:
    """"Last, First", or whichever there is."""
    return F.concat_ws(", ", blank_to_null(last), blank_to_null(first))


def zip5(c: Column) -> Column:
    return F.nullif(F.substring(F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", ""), 1, 5), F.lit(""))


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(*TRUTHY), F.lit(False))


def ward_number(c: Column) -> Column:
    """"12th ward" or "ward 12" -> 12; null without the word."""
    before = F.regexp_extract(c, r"(?i)([0-9]{1,2})(?:st|nd|rd|th)?\s*ward", 1)
    after = F.regexp_extract(c, r"(?i)ward\s*([0-9]{1,2})", 1)
    return F.coalesce(F.nullif(before, F.lit("")), F.nullif(after, F.lit(""))).cast("int")


def district_token(c: Column) -> Column:
    """"District 1A" -> 1a; also a bare number with a or b; null for a bare number."""
    named = F.concat(F.regexp_extract(c, r"(?i)district\s*([0-9]{1,2})\s*([ab])?", 1), F.lower(F.regexp_extract(c, r"(?i)district\s*([0-9]{1,2})\s*([ab])?", 2)))
    lettered = F.concat(F.regexp_extract(c, r"(?i)\b([0-9]{1,2})([ab])\b", 1), F.lower(F.regexp_extract(c, r"(?i)\b([0-9]{1,2})([ab])\b", 2)))
    return F.coalesce(F.nullif(named, F.lit("")), F.nullif(lettered, F.lit("")))


def is_individual_name(c: Column) -> Column:
    low = F.lower(c)
    organisation = F.lit(False)
    for token in ORGANISATION_TOKENS:
        organisation = organisation | F.contains(low, F.lit(token))
    return F.contains(c, F.lit(",")) & ~organisation


def names_the_committee(last: Column, committee: Column) -> Column:
    """A last name of three letters or more stands as a whole word in the committee's name."""
    padded = lambda x: F.concat(F.lit(" "), norm(x), F.lit(" "))
    return (F.length(F.trim(last)) >= 3) & F.contains(padded(committee), padded(last))


def person_slug(c: Column) -> Column:
    """A member's key: accents folded, quoted nicknames, honorifics and bare initials dropped, suffixes and inner hyphens kept."""
    plain = F.regexp_replace(_plain_letters(F.coalesce(c, F.lit("")), False), "[\"“”‘’'].*?[\"“”‘’']", " ")
    words = F.transform(F.split(plain, r"(?U)\s+"), lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}\p{N}_-]", "")))
    kept = F.filter(words, lambda w: (w != "") & ~w.isin(*HONORIFICS) & ((F.length(w) > 1) | w.isin(*SUFFIXES, "v")))
    return F.regexp_replace(F.regexp_replace(F.array_join(kept, "-"), "-{2,}", "-"), "^-+|-+$", "")


def _plain_words(c: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[.,/&'\"()-]", " "), r"\s+", " ")), " ")


def core_tokens(c: Column) -> Column:
    """Words of an organisation's name that tell it from others."""
    return F.filter(_plain_words(c), lambda t: (F.length(t) > 1) & ~t.isin(*ORG_STOP))


def _acronym_words(c: Column) -> Column:
    return F.filter(_plain_words(c), lambda t: (F.length(t) > 1) & ~t.isin(*ACRONYM_STOP))


def acronym(c: Column) -> Column:
    return F.array_join(F.transform(_acronym_words(c), lambda t: F.substring(t, 1, 1)), "")


def compact(c: Column) -> Column:
    return F.array_join(_acronym_words(c), "")


def surname(c: Column) -> Column:
    return F.element_at(_plain_words(c), -1)


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays; 0 where either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1)))


def is_subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def acronym_match(a: Column, b: Column) -> Column:
    """One name, five letters at most when run together, is the other's acronym."""
    ca, cb, aa, ab = compact(a), compact(b), acronym(a), acronym(b)
    return (ca != "") & (cb != "") & (((F.length(ca) <= 5) & (ca == ab)) | ((F.length(cb) <= 5) & (cb == aa)))


def office_kind(c: Column) -> Column:
    return F.when(c.rlike(r"(?i)SCHOOL|EDUCATION|\bBOE\b|\bCPS\b"), "school_board").when(c.rlike(r"(?i)ALDER|\bWARDS?\b|CITY COUNCIL|\bMAYOR"), "municipal")


def race_slug(office: Column, district: Column, ward: Column, election_id: Column) -> Column:
    """The race's part of an address; older elections carry their year."""
    year = F.regexp_extract(F.coalesce(election_id, F.lit("")), "^([0-9]{4})-", 1)
    prefix = F.when(election_id.isNull() | election_id.isin(*BARE_ELECTIONS) | (year == ""), "").otherwise(F.concat(year, F.lit("-")))
    base = F.when(blank_to_null(district).isNotNull(), kebab(district)).when(ward.isNotNull(), F.concat(F.lit("ward-"), ward.cast("string"))).otherwise(kebab(lookup(OFFICE_SLUGS, office, office)))
    return F.concat(prefix, base)


def race_code(office: Column, district: Column, ward: Column, label: Column) -> Column:
    return F.when(blank_to_null(district).isNotNull(), F.regexp_replace(district, r"(?i)^District\s+", "")).when(ward.isNotNull(), F.concat(F.lit("Ward "), ward.cast("string"))).otherwise(lookup(OFFICE_CODES, office, label))


def office_label(office: Column) -> Column:
    return lookup(OFFICE_LABELS, office, office)


def surname_key(c: Column) -> Column:
    """A neutral sort key: the last word, without a generational suffix."""
    plain = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?i),?\s*(jr|sr|ii|iii|iv)\.?$", ""))
    return F.lower(F.element_at(F.split(plain, r"\s+"), -1))


def race_order(race_id: Column, office: Column) -> Column:
    number = F.nullif(F.regexp_extract(F.coalesce(race_id, F.lit("")), "([0-9]+)", 1), F.lit("")).cast("long")
    return F.when((office == "school_board_president") | (race_id == "sb-president"), -1).otherwise(F.coalesce(lookup(CITYWIDE_ORDER, race_id).cast("long"), number, F.lit(9999)))


def cycle_key(c: Column) -> Column:
    """A cycle code's place in time; "pre-YYYY" comes just before YYYY, unknown codes last."""
    pre = F.nullif(F.regexp_extract(c, r"(?i)^pre-?([0-9]{4})", 1), F.lit("")).cast("double") - 0.5
    return F.coalesce(pre, F.nullif(F.regexp_extract(c, "([0-9]{4})", 1), F.lit("")).cast("double"), F.lit(1e9))


def row_year(date: Column, cycle: Column) -> Column:
    return F.coalesce(F.year(date), F.nullif(F.regexp_extract(F.coalesce(cycle, F.lit("")), "([0-9]{4})", 1), F.lit("")).cast("int"))


def recipient_label(ward: Column, name: Column, committee: Column) -> Column:
    return F.when(ward.isNotNull() & name.isNotNull(), F.concat(F.lit("Ward "), ward.cast("string"), F.lit(" — "), name)).when(ward.isNotNull(), F.concat(F.lit("Ward "), ward.cast("string"))).otherwise(committee)


def tally_text(tally: Column) -> Column:
    """A map of counts as text, by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(tally)), lambda e: F.concat(e["key"], F.lit(" "), e["value"].cast("string"))), ", ")


def election_of_race(c: Column) -> Column:
    """The election that a race id claims by its namespace."""
    return F.when(c.startswith("sb-2024-"), "2024-school-board").when(c.startswith("sb-"), "2026-school-board").when(c.startswith("ward-") | c.isin("mayor", "city-clerk", "city-treasurer"), "2027-municipal")


def election_of_candidate(c: Column) -> Column:
    """The election that a candidate id claims by convention; unknown shapes claim none."""
    return (
        F.when(F.contains(c, F.lit("sb-2024-")), "2024-school-board")
        .when(c.rlike("^inc-ward-[0-9]+$"), "2027-municipal")
        .when(c.rlike("^inc-sb-d[0-9]+$"), "2026-school-board")
        .when(c.rlike("(^|-)sb-(d[0-9]+|president)$"), "2026-school-board")
        .when(c.rlike("-ward-[0-9]+$"), "2027-municipal")
    )


def title_keywords(c: Column, least: int = 5, most: int = 3) -> Column:
    """The longest distinctive words of a title; ties by spelling."""
    words = F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z]+", " "), " "), lambda t: (F.length(t) >= least) & ~t.isin(*TITLE_STOP)))
    ranked = F.array_sort(F.transform(words, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t"))))
    return F.transform(F.slice(ranked, 1, most), lambda e: e["t"])


def title_pairs(c: Column, least: int = 7) -> Column:
    """Two-word phrases of a title that are long enough and not of stop words alone."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z]+", " ")), " ")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.when(b.isNotNull() & ~(a.isin(*TITLE_STOP) & b.isin(*TITLE_STOP)), F.concat(a, F.lit(" "), b)))
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull() & (F.length(p) >= least)))


def committee_url(stored: Column, filing_id: Column, base: str) -> Column:
    return F.coalesce(blank_to_null(stored), F.concat(F.lit(base), blank_to_null(filing_id.cast("string"))))


def tsv_safe(c: Column, cap: int = 300) -> Column:
    """One line of at most cap characters."""
    return F.substring(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "[\t\r\n]+", " ")), 1, cap)


def reference_kind(c: Column) -> Column:
    """What an id refers to: a person, a candidacy, none, or a vacancy."""
    c = F.coalesce(F.trim(c), F.lit(""))
    return F.when(F.lower(c) == "vacancy", "vacancy").when((c == "") | (F.lower(c) == "none"), "none").when(c.startswith("person:") | c.startswith("p-"), "person").otherwise("candidate")
