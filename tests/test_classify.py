"""Classification against a direct reading of the rules, request by request."""

import itertools
import re

from sitepulse.operators import classify

LISTS = {
    "ad": ["||ads.example.com^", "/banner/*/img^", "&ad_id=", "||track.", "|http://start.", "swf|", "@@||ads.example.com/ok^",
           "||opt.com^$domain=site.org|~sub.site.org", "plain", "||third.net^$third-party", "||first.net^$~third-party",
           "||script.net^$script", "! note", "[Adblock Plus]", "x.com##.ad", "Case-Word/"],
    "tracker": ["/pixel[0-9]+/", "||ads.example.com^", "||wild*card.com^", "a.b?c=d|e"],
    "social": ["||social.com^", "@@||social.com/share^$domain=site.org"],
}
PAGES = ["http://site.org/", "http://www.site.org/x", "http://sub.site.org/", "http://third.net/", "http://opt.com/"]
URLS = [
    "http://ads.example.com/", "http://x.ads.example.com:80/a", "http://ads.example.com.evil.org/", "http://bads.example.com/",
    "http://ads.example.com/ok", "http://ads.example.com/okay", "http://q.com/banner/1/img", "http://q.com/banner/1/img.png",
    "http://q.com/banner/1/imgs", "http://q.com/?a=1&ad_id=3", "http://q.com/?bad_id=3", "http://www.track.me/", "http://backtrack.me/",
    "http://start.com/", "https://start.com/", "http://q.com/a.swf", "http://q.com/a.swf?x", "http://opt.com/", "http://q.com/aplainb",
    "http://third.net/", "http://first.net/", "http://script.net/", "http://q.com/pixel12", "http://q.com/pixelx", "http://wildXcard.com/",
    "http://social.com/", "http://social.com/share", "http://q.com/Case-Word/", "http://q.com/case-word/", "http://a.b?c=d|e",
    "http://u@ads.example.com/", "http://ads.example.com",
]


def domain(url):
    return ".".join(re.match(r"\w+://(?:[^@/]*@)?([^/:?#]*)", url).group(1).split(".")[-2:])


def expression(pattern):
    if re.fullmatch(r"/.+/", pattern):
        return pattern[1:-1]
    start = "^(?:[^:/?#]+:)?(?://(?:[^/?#]*\\.)?)?" if pattern.startswith("||") else "^" if pattern.startswith("|") else ""
    body = pattern[2:] if pattern.startswith("||") else pattern[1:] if pattern.startswith("|") else pattern
    end = "$" if body.endswith("|") else ""
    body = body[:-1] if end else body
    parts = {"^": r"(?:[^\w\d_\-.%]|$)", "*": ".*"}
    return start + "".join(parts.get(c, re.escape(c)) for c in body) + end


def expected(page, url):
    for name, rules in LISTS.items():
        block = allow = False
        for rule in rules:
            if rule.startswith(("!", "[")) or "##" in rule:
                continue
            exception, rule = rule.startswith("@@"), rule.removeprefix("@@")
            pattern, _, options = rule.partition("$") if re.search(r"\$[~\w]", rule) else (rule, "", "")
            options = options.split(",") if options else []
            if any(not re.match(r"~?third-party|domain=", o) for o in options):
                continue
            holds = True
            for option in options:
                if option.endswith("third-party"):
                    holds &= (domain(page) != domain(url)) != option.startswith("~")
                else:
                    names = option[7:].split("|")
                    # The page's registered domain is what options are held against.
                    yes, no = [n for n in names if n[0] != "~"], [n[1:] for n in names if n[0] == "~"]
                    holds &= (not yes or domain(page) in yes) and domain(page) not in no
            if holds and re.search(expression(pattern), url):
                allow, block = allow or exception, block or not exception
        if block and not allow:
            return name
    return ""


def test_against_direct_reading(spark):
    lines = [(name, i, rule) for i, (name, rules) in enumerate(LISTS.items()) for rule in rules]
    rules = classify.parse_rules(spark.createDataFrame(lines, "list string, priority int, line string"))
    pairs = list(itertools.product(PAGES, URLS)) + [(PAGES[0], URLS[0])] * 50
    found = classify.classify(spark.createDataFrame(pairs, "page string, url string"), rules).collect()
    assert len(found) == len(pairs)
    wrong = {(r.page, r.url, r.type, expected(r.page, r.url)) for r in found if r.type != expected(r.page, r.url)}
    assert not wrong
    assert {r.type for r in found} == {"ad", "tracker", "social", ""}
