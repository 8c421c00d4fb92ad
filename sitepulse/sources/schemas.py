"""Schemas of the flat tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"STRING": T.StringType(), "BOOLEAN": T.BooleanType(), "BIGINT": T.LongType()}


def _schema(ddl: str) -> T.StructType:
    """Plain ``name TYPE, ...``, read without a session, which Spark's own parser would need."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (part.split() for part in ddl.split(","))])


# Columns of the flat page and request dumps.
SUMMARY_PAGES = _schema(
    """
    pageid BIGINT, createDate BIGINT, archive STRING, label STRING, crawlid BIGINT, wptid STRING,
    wptrun BIGINT, url STRING, urlShort STRING, urlhash BIGINT, cdn STRING, startedDateTime BIGINT,
    TTFB BIGINT, renderStart BIGINT, onContentLoaded BIGINT, onLoad BIGINT, fullyLoaded BIGINT,
    visualComplete BIGINT, PageSpeed BIGINT, SpeedIndex BIGINT, rank BIGINT, reqTotal BIGINT,
    reqHtml BIGINT, reqJS BIGINT, reqCSS BIGINT, reqImg BIGINT, reqGif BIGINT, reqJpg BIGINT, reqPng
    BIGINT, reqFont BIGINT, reqFlash BIGINT, reqJson BIGINT, reqOther BIGINT, bytesTotal BIGINT,
    bytesHtml BIGINT, bytesJS BIGINT, bytesCSS BIGINT, bytesImg BIGINT, bytesGif BIGINT, bytesJpg
    BIGINT, bytesPng BIGINT, bytesFont BIGINT, bytesFlash BIGINT, bytesJson BIGINT, bytesOther
    BIGINT, bytesHtmlDoc BIGINT, numDomains BIGINT, maxDomainReqs BIGINT, numRedirects BIGINT,
    numErrors BIGINT, numGlibs BIGINT, numHttps BIGINT, numCompressed BIGINT, numDomElements BIGINT,
    maxageNull BIGINT, maxage0 BIGINT, maxage1 BIGINT, maxage30 BIGINT, maxage365 BIGINT, maxageMore
    BIGINT, gzipTotal BIGINT, gzipSavings BIGINT, _connections BIGINT, _adult_site BOOLEAN,
    avg_dom_depth BIGINT, document_height BIGINT, document_width BIGINT, localstorage_size BIGINT,
    sessionstorage_size BIGINT, num_iframes BIGINT, num_scripts BIGINT, doctype STRING,
    meta_viewport STRING, reqAudio BIGINT, reqVideo BIGINT, reqText BIGINT, reqXml BIGINT, reqWebp
    BIGINT, reqSvg BIGINT, bytesAudio BIGINT, bytesVideo BIGINT, bytesText BIGINT, bytesXml BIGINT,
    bytesWebp BIGINT, bytesSvg BIGINT, num_scripts_async BIGINT, num_scripts_sync BIGINT, usertiming
    BIGINT
    """
)

SUMMARY_REQUESTS = _schema(
    """
    requestid BIGINT, pageid BIGINT, startedDateTime BIGINT, time BIGINT, method STRING, url STRING,
    urlShort STRING, redirectUrl STRING, firstReq BOOLEAN, firstHtml BOOLEAN, reqHttpVersion STRING,
    reqHeadersSize BIGINT, reqBodySize BIGINT, reqCookieLen BIGINT, reqOtherHeaders STRING, status
    BIGINT, respHttpVersion STRING, respHeadersSize BIGINT, respBodySize BIGINT, respSize BIGINT,
    respCookieLen BIGINT, expAge BIGINT, mimeType STRING, respOtherHeaders STRING, req_accept
    STRING, req_accept_charset STRING, req_accept_encoding STRING, req_accept_language STRING,
    req_connection STRING, req_host STRING, req_if_modified_since STRING, req_if_none_match STRING,
    req_referer STRING, req_user_agent STRING, resp_accept_ranges STRING, resp_age STRING,
    resp_cache_control STRING, resp_connection STRING, resp_content_encoding STRING,
    resp_content_language STRING, resp_content_length STRING, resp_content_location STRING,
    resp_content_type STRING, resp_date STRING, resp_etag STRING, resp_expires STRING,
    resp_keep_alive STRING, resp_last_modified STRING, resp_location STRING, resp_pragma STRING,
    resp_server STRING, resp_transfer_encoding STRING, resp_vary STRING, resp_via STRING,
    resp_x_powered_by STRING, _cdn_provider STRING, _gzip_save BIGINT, crawlid BIGINT, type STRING,
    ext STRING, format STRING
    """
)

RANKED_URLS = T.StructType(
    [
        T.StructField("alexa_domain", T.StringType()),
        T.StructField("alexa_rank", T.LongType()),
        T.StructField("dmoz_topic", T.ArrayType(T.StringType())),
        T.StructField("dmoz_url", T.StringType()),
        T.StructField("dmoz_title", T.StringType()),
        T.StructField("dmoz_description", T.StringType()),
    ]
)
