"""Host and registered-domain expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Two-label public suffixes told apart from plain domains. No suffix list ships
# with Spark; a caller may pass a longer one.
TWO_PART_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "nhs.uk", "org.uk", "plc.uk",
    "police.uk", "sch.uk", "com.au", "edu.au", "gov.au", "id.au", "net.au", "org.au", "com.br",
    "gov.br", "net.br", "org.br", "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn", "co.in",
    "gov.in", "net.in", "org.in", "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp", "co.kr", "go.kr",
    "or.kr", "com.mx", "org.mx", "co.nz", "govt.nz", "net.nz", "org.nz", "com.sg", "com.tr",
    "com.tw", "co.za", "org.za",
)


# Authority without user info and port, in one expression.
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#]*@)?([^/?#@]*?)(?::\d*)?(?=[/?#]|$)"


def host(url: Column) -> Column:
    """Lower-case host, without user info and port. Works on URLs a strict parser rejects."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def _domain_of(name: Column, suffixes: tuple[str, ...]) -> Column:
    last_two = F.substring_index(name, ".", -2)
    domain = F.when(last_two.isin(*suffixes), F.substring_index(name, ".", -3)).otherwise(last_two)
    return F.when(name.rlike(r"^\d+(\.\d+){3}$"), name).otherwise(domain)


def _once(value: Column, of) -> Column:
    """``of(value)`` with ``value`` bound to a name, so that it is computed once and its code stands once."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def registered_domain(url: Column, suffixes: tuple[str, ...] = TWO_PART_SUFFIXES) -> Column:
    """Public suffix plus one label; the host itself when it has fewer labels or is an address."""
    return _once(host(url), lambda name: _domain_of(name, suffixes))


def subdomain(url: Column, suffixes: tuple[str, ...] = TWO_PART_SUFFIXES) -> Column:
    """What stands before the registered domain; empty when nothing does."""

    def before(name: Column) -> Column:
        rest = F.length(name) - F.length(_domain_of(name, suffixes)) - 1
        return F.when(rest > 0, F.left(name, rest)).otherwise(F.lit(""))

    return _once(host(url), before)


def path(url: Column) -> Column:
    """Path part; a URL without one has the root path."""
    found = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*([^?#]*)", 1)
    return F.when(found == "", F.lit("/")).otherwise(found)


def domain_suffixes(name: Column) -> Column:
    """A host and all its parent names: ``a.b.c`` -> ``[a.b.c, b.c, c]``."""
    labels = F.split(name, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )


def is_third_party(page: Column, url: Column) -> Column:
    return registered_domain(page) != registered_domain(url)
