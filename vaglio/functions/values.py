"""Coercions of extracted values, JSON paths, prompts and budgets, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaglio.functions.text import collapse, let, strip

#: The categories.
CATEGORIES = ("Digital & Innovation", "Sustainability", "Startups & SMEs", "Research & Development", "Culture & Tourism", "Internationalization", "Training", "Agriculture", "Other")
#: Fields of a payload that become text, in this order.
PAYLOAD_FIELDS = ("callTitle", "description", "destinationDetails", "budget", "deadlineDate", "closingDate", "deadlineModel", "duration", "programmeDivision", "typesOfAction", "callccm2Id")
#: Fixed value: words that differ between portals for one scheme.
TITLE_NOISE = r"(?U)\b(bando|avviso|pubblico|contributi?|contributo|finanziamento|voucher|fondo|misura|anno|edizione|20\d{2})\b"
MAX_REQUIREMENTS = 20


def category(c: Column) -> Column:
    """The known category that c is, whatever its case and outer blanks; 'Other' for anything else and null."""
    key = F.lower(strip(c))
    found = F.lit("Other")
    for name in reversed(CATEGORIES):
        found = F.when(key == name.lower(), F.lit(name)).otherwise(found)
    return found


def deadline(c: Column) -> Column:
    """value (date) and failed: an ISO date; other text is no deadline; an ISO date that does not exist fails."""
    text = strip(c)
    iso = F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))
    value = F.when(iso, F.try_to_date(text, "yyyy-MM-dd"))
    return F.struct(value.alias("value"), (iso & value.isNull()).alias("failed"))


def amount(c: Column) -> Column:
    """A number in Italian format with all else dropped; null if nothing is left or it is none. Signs are dropped."""
    kept = F.replace(F.replace(F.regexp_replace(c, r"[^\d,.]", ""), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.nullif(kept, F.lit("")).try_cast("double")


def requirements(c: Column) -> Column:
    """The first 20 non-blank items, stripped; an empty list for null."""
    kept = F.filter(F.transform(c, strip), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.slice(kept, 1, MAX_REQUIREMENTS), F.array().cast("array<string>"))


def normalise_title(c: Column) -> Column:
    """Lower case, without noise words, years and punctuation."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(c), TITLE_NOISE, " "), r"(?U)[^\w\s]", " ")
    return collapse(plain)


def sorted_words(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(c, " ")), " ")


def iso_date(c: Column) -> Column:
    """The date that a date or timestamp string begins with; null if it is none."""
    return F.when(F.substring(c, 1, 10).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"))


def iso_timestamp(c: Column) -> Column:
    """The moment that an ISO string with an offset, or Z, names; null if it is none."""
    return F.try_to_timestamp(F.regexp_replace(strip(c), r"(?i)z$", "+00:00"))


def dig(json: Column, path: str) -> Column:
    """The scalar (or JSON text) at a dotted path; a list on the way or at the end stands for its first element."""
    def first(j: Column) -> Column:
        return F.when(F.ltrim(j).startswith("["), F.get_json_object(j, "$[0]")).otherwise(j)

    current = json
    for part in path.split("."):
        step = f"$.{part}"
        current = let(current, lambda j: F.get_json_object(first(j), step))  # noqa: B023 - built at once
    return let(current, first)


def payload_text(title: Column, payload: Column, url: Column) -> Column:
    """A record of an API as labelled lines; blank and missing fields are left out."""
    line = lambda label, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{label}: "), value))
    fields = [line(k, dig(payload, f"metadata.{k}")) for k in PAYLOAD_FIELDS]
    every = F.array(line("Title", title), *fields, line("Summary", F.get_json_object(payload, "$.summary")), F.concat(F.lit("URL: "), F.coalesce(url, F.lit(""))))
    return F.array_join(F.filter(every, lambda x: x.isNotNull()), "\n")


def page_url(url: Column, parameter: Column, page: Column) -> Column:
    """The URL of a page; the first, or without a parameter, is the URL itself."""
    glue = F.when(F.contains(url, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.when((page > 1) & (F.coalesce(parameter, F.lit("")) != ""), F.concat(url, glue, parameter, F.lit("="), page.cast("string"))).otherwise(url)


def source_budget(cap: Column, sources: Column) -> Column:
    """Calls each source may make: null for one source, else three fair shares, ten at least."""
    return F.when(sources > 1, F.greatest(F.lit(10), 3 * F.floor(cap / sources).cast("int")))


def calls_remaining(cap: Column, used: Column, budget: Column, source_used: Column) -> Column:
    """What is left of the run's and the source's calls, never below none. A null budget does not bind."""
    run = cap - used
    return F.greatest(F.lit(0), F.coalesce(F.least(run, budget - source_used), run))


#: What a prompt says around its parts.
TOPICS_HEAD, TEXT_HEAD, NO_TOPICS, NO_DESCRIPTION = "TOPICS TO SCORE:\n", "PAGE CONTENT:\n", "(no topics defined — return an empty relevance array)", "no description"
RETRY_HEAD, RETRY_TAIL = "Your previous response failed schema validation with:\n", "Return corrected JSON matching the schema exactly."


def topic_list(topics: DataFrame) -> DataFrame:
    """topics: the active topics as one array, ordered by id. They are a fixed list of a person's making, read into every prompt."""
    return topics.agg(F.array_sort(F.collect_list(F.struct("id", "name", "description"))).alias("topics"))


def prompt(url: Column, topics: Column, text: Column) -> Column:
    """What a model is asked: the page's address, the topics, a line each, and its text. topics: array of id, name, description; null or empty says that there are none."""
    line = lambda t: F.concat(F.lit("- id="), t["id"], F.lit(" name="), t["name"], F.lit(": "), F.coalesce(F.nullif(t["description"], F.lit("")), F.lit(NO_DESCRIPTION)))
    lines = F.array_join(F.transform(topics, line), "\n")
    return F.concat_ws("\n\n", F.concat(F.lit("URL: "), url), F.concat(F.lit(TOPICS_HEAD), F.coalesce(F.nullif(lines, F.lit("")), F.lit(NO_TOPICS))), F.concat(F.lit(TEXT_HEAD), text))


def retry_prompt(first: Column, errors: Column) -> Column:
    """What a model is asked again: the first prompt, what was wrong with the answer, and to mend it."""
    return F.concat_ws("\n\n", first, F.concat(F.lit(RETRY_HEAD), errors), F.lit(RETRY_TAIL))


def relevant_topics(relevance: Column, threshold: float = 0.5) -> Column:
    """topic_id of the scores from threshold on; null if there is none."""
    kept = F.transform(F.filter(relevance, lambda x: x["score"] >= threshold), lambda x: x["topic_id"])
    return F.when(F.size(kept) > 0, kept)


def best_relevance(relevance: Column) -> Column:
    return F.array_max(F.transform(relevance, lambda x: x["score"]))
