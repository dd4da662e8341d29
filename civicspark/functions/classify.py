"""Classification by ordered rules: a table of patterns becomes one CASE expression, first match wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name patterns in the order in which they are tried.
INDUSTRY_RULES = [
    (r"\b(ctu|chicago teachers union|cook county college teachers|teachers? union|federation of teachers|education association)\b", "labor-teachers"),
    (r"\b(seiu|hospital workers|nurses?|healthcare workers?)\b", "labor-service"),
    (r"\b(afscme|public employees? union)\b", "labor-public"),
    (r"\b(carpenters|laborers|ironworkers|electricians|operating engineers|operators? joint|pipe(?:fitters?|trades?)|sheet metal|plasterers|painters|teamsters|building trades)\b", "labor-trades"),
    (r"\b(union|local \d+|council \d+|brotherhood|cope|ibew|atu|cwa)\b", "labor-trades"),
    (r"\b(united working families|uwf|ipo|independent political org|reclaim chicago|grassroots|justice democrats)\b", "progressive-pol"),
    (r"\b(real estate|realty|realtors?|developers?|properties|building owners|apartment association|boma)\b", "real-estate"),
    (r"\b(construction|builders|contractors? association)\b", "real-estate"),
    (r"\b(restaurant|cafe|brewery|hospitality|bar association|illinois restaurant)\b", "restaurant"),
    (r"\b(bank|jpmorgan|chase|citigroup|wells fargo|credit union|investment management|hedge fund|private equity)\b", "finance"),
    (r"\b(google|microsoft|amazon|tech|software|ai|cloud)\b", "tech"),
    (r"\b(fop|fraternal order of police|police union)\b", "police-fop"),
    (r"\b(charter|kipp|noble network|illinois network of charter schools)\b", "charter-schools"),
    (r"\b(comed|peoples gas|nicor|chevron|exxon|bp |conoco|petroleum)\b", "fossil-fuels"),
    (r"\b(cannabis|dispensary|cresco|green thumb|verano)\b", "cannabis"),
    (r"\b(hospital|medical center|pharmaceutical|pharma|advocate health)\b", "healthcare"),
    (r"\bpac\b", "establishment-pol"),
]
OCCUPATION_RULES = [
    (r"\b(broker|real estate|realtor)\b", "real-estate"),
    (r"\b(developer|builder|construction|architect|landlord)\b", "real-estate"),
    (r"\b(restaurateur|restaurant owner|chef|bartender|hospitality)\b", "restaurant"),
    (r"\b(banker|investment|financial advisor|trader|hedge fund|portfolio manager|wealth manager)\b", "finance"),
    (r"\b(physician|doctor|nurse|medical)\b", "healthcare"),
    (r"\b(attorney|lawyer|counsel|paralegal)\b", "legal"),
    (r"\b(teacher|professor|educator|principal)\b", "labor-teachers"),
    (r"\b(police officer|detective|patrolman|sergeant)\b", "police-fop"),
    (r"\b(union\b|labor organizer)\b", "labor-trades"),
    (r"\b(engineer\b|software|developer|programmer)\b", "tech"),
    (r"\b(retired|homemaker|self.employed|student|self)\b", "individual"),
]


def first_match(c: Column, rules: Sequence[tuple[str, str]], default: Column | None = None) -> Column:
    """The label of the first pattern found in c, else default (null)."""
    low = F.lower(c)
    out = None
    for pattern, label in rules:
        hit = low.rlike(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    if out is None:
        return default if default is not None else F.lit(None).cast("string")
    return out if default is None else out.otherwise(default)


def industry(name: Column, individual: Column, rules: Sequence[tuple[str, str]] = tuple(INDUSTRY_RULES)) -> Column:
    """A donor's main industry; people are "individual", names without a match "unclassified"."""
    return F.when(individual, "individual").otherwise(first_match(name, rules, F.lit("unclassified")))


def suggestion(employer: Column, occupation: Column, name: Column, employer_rules: Sequence[tuple[str, str]], occupation_rules: Sequence[tuple[str, str]]) -> Column:
    """struct(industry, reason): by employer, else occupation, else a name without a comma, else the comma form; null where nothing speaks."""
    by_employer, by_job = first_match(employer, employer_rules), first_match(occupation, occupation_rules)
    by_name = F.when(~F.contains(name, F.lit(",")), first_match(name, employer_rules))
    found = F.when(by_employer.isNotNull(), F.struct(by_employer.alias("industry"), F.concat(F.lit('employer: "'), F.substring(F.lower(employer), 1, 50), F.lit('"')).alias("reason")))
    found = found.when(by_job.isNotNull(), F.struct(by_job.alias("industry"), F.concat(F.lit('occupation: "'), F.substring(F.lower(occupation), 1, 40), F.lit('"')).alias("reason")))
    found = found.when(by_name.isNotNull(), F.struct(by_name.alias("industry"), F.lit("name pattern").alias("reason")))
    return found.when(F.contains(name, F.lit(",")), F.struct(F.lit("individual").alias("industry"), F.lit("name format (Last, First)").alias("reason")))


def industry_class(tags: Column) -> Column:
    """substantive, individual_only or unclassified, from a donor's tags."""
    plain = F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: t != "unclassified")
    return F.when(F.size(plain) == 0, "unclassified").when(F.forall(plain, lambda t: t == "individual"), "individual_only").otherwise("substantive")


def is_unclassified(tags: Column) -> Column:
    return F.forall(F.coalesce(tags, F.array().cast("array<string>")), lambda t: t == "unclassified")


# Patterns for employers and for names that the rules above leave open, in order.
EMPLOYER_RULES = [
    (r"\b(teachers?\s*union|federation of teachers|ctu|chicago teachers|education association)\b", "labor-teachers"),
    (r"\b(seiu|hospital workers?|nurses?\s*union)\b", "labor-service"),
    (r"\b(afscme|public employees? union)\b", "labor-public"),
    (r"\b(carpenters|laborers|ironworkers|electricians|operating engineers|operators? joint|pipe(?:fitters?|trades?)|sheet metal|plasterers|painters|teamsters|building trades|ibew|iuoe)\b", "labor-trades"),
    (r"\b(federation of labor|labor council|labor federation|workers united|aflcio|afl.cio)\b", "labor-trades"),
    (r"\b(union|local \d+|brotherhood|cope|atu|cwa)\b", "labor-trades"),
    (r"\b(united working families|uwf|reclaim chicago|grassroots|justice democrats|indivisible|peoples action|democratic socialists|dsa\b|\bdsa\s+of)\b", "progressive-pol"),
    (r"\b(real estate|realty|realtors?|properties|property management|developers?|brokers?|leasing|boma)\b", "real-estate"),
    (r"\b(construction|builders|contracting|architects?|engineering firm|engineers? llc|civil engineering)\b", "real-estate"),
    (r"\b(landlord|residential|commercial property|apartments?\s*llc|reit|management llc|management group|flat iron)\b", "real-estate"),
    (r"\b(restaurant|cafe|tavern|brewery|brewing|hospitality|catering|hotel|inn\s|bar\s+&|grill\s|kitchen\s+llc|diner|bistro|pizzeria|eatery|dining)\b", "restaurant"),
    (r"\b(illinois restaurant|nightlife|club\s+llc|venue|music hall|concert venue)\b", "restaurant"),
    (r"\b(bank|jpmorgan|chase|citigroup|wells fargo|credit union|investments?|hedge fund|private equity|wealth management|asset management|broker.dealer|insurance group|mortgage)\b", "finance"),
    (r"\b(technology|software|google|microsoft|amazon|tech\s*(inc|llc|corp)|cloud|systems\s*llc|saas|ai\s*(inc|labs))\b", "tech"),
    (r"\b(fop|fraternal order of police|police officers? association|police union)\b", "police-fop"),
    (r"\b(charter|kipp|noble network|illinois network of charter schools|inocs)\b", "charter-schools"),
    (r"\b(comed|peoples gas|nicor|chevron|exxon|bp\s+(plc|inc|america)|conoco|petroleum|gas company|exelon)\b", "fossil-fuels"),
    (r"\b(cannabis|dispensary|cresco|green thumb|verano|cookies\s+llc)\b", "cannabis"),
    (r"\b(hospital|medical center|pharmaceutical|pharma|advocate health|northwestern medicine|rush\s+university|biotech|pharma\s*(inc|corp))\b", "healthcare"),
    (r"\b(law firm|attorneys?\s+(at law|llp|llc)|legal services|lobbyists?|\bllp\b)\b", "legal"),
    (r"\b(self.employed|self employed|retired|homemaker|not employed|unemployed|n/a|none)\b", "individual"),
]
