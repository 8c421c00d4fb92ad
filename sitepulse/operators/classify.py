"""Classification of requests against ordered filter lists.

Rules become a table. A URL that a rule matches holds the rule's tokens: the host it is anchored to, its delimited
words, or else the runs of four or three characters of its plain text. How often each of these tokens occurs in the
URLs at hand is counted, and a rule is filed under its rarest one. URLs are looked up by equality with the tokens that
have a rule, and a rule's expression is checked on those few candidates only. What is left are expressions without any
plain run; they are put into combined expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sitepulse.functions import weburl
from sitepulse.session import stage

# Filter syntax.
_SUPPORTED_OPTION = r"^(~?third-party|domain=.*)$"
_OPTIONS = r"\$(~?[\w-]+(?:=[^,\s]+)?(?:,~?[\w-]+(?:=[^,\s]+)?)*)$"
_SEPARATOR = r"(?:[^\w\d_\-.%]|$)"
_DOMAIN_START = r"^(?:[^:/?#]+:)?(?://(?:[^/?#]*\.)?)?"
# Words so common in URLs that looking a rule up by them would select nearly all.
_COMMON_WORDS = ("http", "https", "www", "com", "net", "org", "html", "js", "css", "index", "php")
_WORD = r"[A-Za-z0-9%]"
# Alternatives per combined expression.
_COMBINED = 100
# Runs of plain text that rules without a word are filed under, longer ones first.
_GRAMS = (4, 3)
_KEY = "array<struct<kind: string, key: string>>"


def parse_rules(lines: DataFrame) -> DataFrame:
    """Rule table from lines ``list, priority, line``.

    Columns: ``list, priority, exception, regex, third_party, include, exclude, keys``. Every URL the rule matches has
    all of its ``keys``; a rule without any can match anywhere.
    Comments, element-hiding rules and rules with other options than ``third-party`` and
    ``domain`` are left out.
    """
    line = F.trim("line")
    rules = lines.withColumn("_line", line).where(
        (line != "") & ~line.startswith("!") & ~line.rlike(r"^\[") & ~line.rlike(r"#@?[?$]?#")
    )
    exception = F.col("_line").startswith("@@")
    body = F.when(exception, F.substring(F.col("_line"), F.lit(3), F.length("_line"))).otherwise(F.col("_line"))
    is_regex = F.col("_body").rlike(r"^/.+/$")
    option_text = F.when(is_regex, "").otherwise(F.regexp_extract("_body", _OPTIONS, 1))
    rules = (
        rules.withColumns({"exception": exception, "_body": body})
        .withColumn("_option_text", option_text)
        .withColumn("_options", F.filter(F.split("_option_text", ","), lambda o: o != ""))
        .where(F.forall("_options", lambda o: o.rlike(_SUPPORTED_OPTION)))
    )
    domains = F.flatten(
        F.transform(
            F.filter("_options", lambda o: o.startswith("domain=")),
            lambda o: F.split(F.substring(o, F.lit(8), F.length(o)), r"\|"),
        )
    )
    pattern = F.when(
        F.length("_option_text") > 0,
        F.substring(F.col("_body"), F.lit(1), F.length("_body") - F.length("_option_text") - 1),
    ).otherwise(F.col("_body"))
    rules = rules.withColumns(
        {
            "third_party": F.when(F.array_contains("_options", "third-party"), True).when(
                F.array_contains("_options", "~third-party"), False
            ),
            "include": F.filter(domains, lambda d: ~d.startswith("~")),
            "exclude": F.transform(
                F.filter(domains, lambda d: d.startswith("~")), lambda d: F.substring(d, F.lit(2), F.length(d))
            ),
            "_pattern": pattern,
        }
    )
    anchored = F.regexp_extract("_pattern", r"^\|\|([A-Za-z0-9][A-Za-z0-9.\-]*)[\^/:?]", 1)
    words = F.regexp_extract_all(
        F.col("_pattern"), F.lit(f"(?<=[^A-Za-z0-9%*])({_WORD}{{2,}})(?=[^A-Za-z0-9%*])"), F.lit(1)
    )
    regular = F.col("_pattern").rlike(r"^/.+/$")
    return rules.withColumns({"_anchored": anchored, "_words": words, "_regular": regular}).select(
        "list",
        "priority",
        "exception",
        _expression(F.col("_pattern")).alias("regex"),
        "third_party",
        "include",
        "exclude",
        _rule_keys().alias("keys"),
    )


def _rule_keys() -> Column:
    """The tokens of every URL that a rule matches: host and rare words, or else runs of its plain text."""
    none = F.array().cast(_KEY)
    host = F.when(F.col("_anchored") != "", _as_keys("host", F.array(F.lower("_anchored")))).otherwise(none)
    rare = F.filter("_words", lambda w: ~F.lower(w).isin(*_COMMON_WORDS))
    found = F.when(~F.col("_regular"), F.concat(host, _as_keys("word", rare))).otherwise(none)

    # Plain text between what stands for something else.
    body = F.regexp_replace("_pattern", r"^\|{1,2}|\|$", "")
    inner = F.substring(F.col("_pattern"), F.lit(2), F.length("_pattern") - 2)
    for of, sign in (
        (r"(?<!\\)\[(?:\\.|[^\]\\])*\]", "\u0001"),  # classes
        (r"\\[A-Za-z0-9]", "\u0001"),
        (r"\\(.)", "$1\u0002"),  # a sign that stands for itself
        (r".\u0002?[*?]", "\u0001"),  # what may be missing
        (r".\u0002?\{[^}]*\}", "\u0001"),
        (r"[.+^$](?!\u0002)", "\u0001"),
        (r"\u0002", ""),
    ):
        inner = F.regexp_replace(inner, of, sign)
    inner = F.when(F.col("_pattern").rlike(r"[|()]|\\\\"), "").otherwise(inner)
    runs = F.when(F.col("_regular"), F.split(inner, "\u0001")).otherwise(F.split(body, r"[*^]"))

    def grams(size: int) -> Column:
        pieces = F.filter(runs, lambda r: F.length(r) >= size)
        return _as_keys(f"gram{size}", F.flatten(F.transform(pieces, lambda r: _grams(r, size))))

    longer = grams(_GRAMS[0])
    return F.when(F.size(found) > 0, found).when(F.size(longer) > 0, longer).otherwise(grams(_GRAMS[1]))


def _as_keys(kind: str, values: Column) -> Column:
    return F.transform(F.array_distinct(values), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("key")))


def _grams(text: Column, size: int) -> Column:
    """All runs of so many characters of a text that has that many."""
    return F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, F.lit(size)))


def _character(c: Column) -> Column:
    """One character of a filter pattern: two stand for something, signs stand for themselves."""
    return (
        F.when(c == "*", F.lit(".*"))
        .when(c == "^", F.lit(_SEPARATOR))
        .when(c.rlike(r"^[^\w\s]$"), F.concat(F.lit("\\"), c))
        .otherwise(c)
    )


def _expression(pattern: Column) -> Column:
    """A filter pattern as a regular expression."""
    inner = F.substring(pattern, F.lit(2), F.length(pattern) - 2)
    start = F.when(pattern.startswith("||"), 2).when(pattern.startswith("|"), 1).otherwise(0)
    end = F.when(pattern.endswith("|") & (F.length(pattern) > start), 1).otherwise(0)
    middle = F.substring(pattern, start + 1, F.length(pattern) - start - end)
    free = F.array_join(F.transform(F.split(middle, ""), _character), "")
    anchor = F.when(start == 2, _DOMAIN_START).when(start == 1, "^").otherwise("")
    whole = F.concat(anchor, free, F.when(end == 1, "$").otherwise(""))
    return F.when(pattern.rlike(r"^/.+/$"), inner).otherwise(whole)


def _options_hold(third_party: Column, include: Column, exclude: Column) -> Column:
    """Whether a rule's options fit the request's page and party."""
    names = F.col("_page_domains")
    return (
        (third_party.isNull() | (third_party == F.col("_third_party")))
        & ((F.size(include) == 0) | F.arrays_overlap(include, names))
        & ((F.size(exclude) == 0) | ~F.arrays_overlap(exclude, names))
    )


def _keys(url: Column, kinds: Sequence[str]) -> Column:
    """Everything in a URL a rule can be looked up by: parent names of its host, its words, runs of its characters."""
    authority = F.regexp_extract(url, r"^(?:[^:/?#]+:)?(?://)?([^/?#]*)", 1)
    pieces = F.filter(F.split(F.lower(authority), r"[^\w.%\-]+"), lambda p: p != "")
    found = {
        "host": F.flatten(F.transform(pieces, weburl.domain_suffixes)),
        "word": F.filter(F.split(url, f"{_WORD.replace('[', '[^')}+"), lambda w: F.length(w) > 1),
    }
    found |= {
        f"gram{size}": F.when(F.length(url) >= size, _grams(url, size)).otherwise(F.array().cast("array<string>")) for size in _GRAMS
    }
    parts = [_as_keys(kind, found[kind]) for kind in kinds]
    return F.concat(*parts) if parts else F.array().cast(_KEY)


def filed(rules: DataFrame, urls: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rules with the ``kind`` and ``key`` they are looked up by, the rarest of their keys in ``urls``, and the kinds in use.

    A rule one of whose keys is in no URL matches none and is left out.
    """
    keyed = stage(rules.where(F.size("keys") > 0).withColumn("_rule", F.monotonically_increasing_id()), "rules")
    offered = keyed.select("_rule", F.inline("keys"))
    kinds = sorted(r.kind for r in offered.select("kind").distinct().collect())
    wanted = offered.select("kind", "key").distinct()
    in_urls = urls.select(F.inline(_keys(F.col("url"), kinds))).join(wanted, ["kind", "key"], "left_semi")
    counts = in_urls.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("_n"))
    rated = offered.join(counts, ["kind", "key"], "left").groupBy("_rule").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "kind", "key")).alias("_best")
    )
    chosen = rated.where("_best.n > 0").select("_rule", "_best.kind", "_best.key")
    return stage(keyed.drop("keys").join(chosen, "_rule").drop("_rule"), "filed-rules"), kinds


def _anywhere(rules: Sequence) -> dict[tuple[str, bool], Column]:
    """Per list and exception flag: does any rule without a key match? Built from the rule lists alone."""
    grouped: dict[tuple, list[str]] = {}
    for rule in rules:
        options = (rule.third_party, tuple(rule.include), tuple(rule.exclude))
        grouped.setdefault((rule.list, rule.exception, options), []).append(rule.regex)
    found: dict[tuple[str, bool], Column] = {}
    for (name, exception, (third_party, include, exclude)), expressions in grouped.items():
        hit = F.lit(False)
        for i in range(0, len(expressions), _COMBINED):
            hit = hit | F.col("url").rlike("|".join(f"(?:{e})" for e in expressions[i : i + _COMBINED]))
        holds = _options_hold(
            F.lit(third_party).cast("boolean"),
            F.array(*[F.lit(d) for d in include]).cast("array<string>"),
            F.array(*[F.lit(d) for d in exclude]).cast("array<string>"),
        )
        found[name, exception] = found.get((name, exception), F.lit(False)) | (holds & hit)
    return found


def classify(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """Columns ``page, url, type``: the first list that blocks the request, or an empty text.

    A list blocks when one of its rules matches and none of its exceptions does. Equal URLs on
    pages of one domain are decided once, however often they occur.
    """
    names = [
        row.list
        for row in rules.groupBy("list").agg(F.min("priority").alias("p")).orderBy("p").collect()
    ]
    keyless = rules.where(F.size("keys") == 0).drop("keys").collect()
    keyed = requests.withColumns(
        {
            "_page_host": weburl.host(F.col("page")),
            "_third_party": F.coalesce(weburl.is_third_party(F.col("page"), F.col("url")), F.lit(True)),
        }
    ).withColumn("_domain", weburl.registered_domain(F.col("page")))
    decide = ["url", "_domain", "_third_party"]
    distinct = stage(keyed.select(*decide).distinct(), "distinct-urls")
    distinct = distinct.withColumn("_page_domains", weburl.domain_suffixes(F.col("_domain")))
    index, kinds = filed(rules, distinct)
    # Tokens that no rule is filed under go before the rules are met.
    candidates = distinct.select(*decide, "_page_domains", F.inline(_keys(F.col("url"), kinds)))
    hits = (
        candidates.join(index, ["kind", "key"])
        .where(_options_hold(F.col("third_party"), F.col("include"), F.col("exclude")))
        .where(F.expr("url RLIKE regex"))
    )
    flags = [
        F.max((F.col("list") == name) & (F.col("exception") == exception)).alias(f"_{kind}{i}")
        for i, name in enumerate(names)
        for kind, exception in (("block", False), ("allow", True))
    ]
    decided = distinct.join(hits.groupBy(*decide).agg(*flags), decide, "left")
    anywhere = _anywhere(keyless)
    kind = F.lit("")
    for i, name in reversed(list(enumerate(names))):
        block = F.coalesce(F.col(f"_block{i}"), F.lit(False)) | anywhere.get((name, False), F.lit(False))
        allow = F.coalesce(F.col(f"_allow{i}"), F.lit(False)) | anywhere.get((name, True), F.lit(False))
        kind = F.when(block & ~allow, F.lit(name)).otherwise(kind)
    types = decided.select(*decide, kind.alias("type"))
    return keyed.join(types, decide, "left").select("page", "url", F.coalesce("type", F.lit("")).alias("type"))
