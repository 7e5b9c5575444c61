"""URLs as column expressions; ASCII hosts, without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TRACKING = "fbclid gclid mc_cid mc_eid msclkid utm_campaign utm_content utm_medium utm_source utm_term".split()
KINDS = {"image": "jpg jpeg png gif webp svg bmp tiff avif", "audio": "mp3 wav ogg flac m4a aac", "video": "mp4 webm mov mkv avi m4v", "document": "pdf doc docx ppt pptx xls xlsx odt epub"}


def part(url: Column, group: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query with its mark, 5 fragment with its mark."""
    return F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$", group)


def host(url: Column) -> Column:
    """Lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_replace(F.regexp_replace(part(url, 2), r"^.*@", ""), r":\d*$", ""))


def port(url: Column) -> Column:
    """The port with its colon, empty if there is none or the scheme's own."""
    p, scheme = F.regexp_extract(part(url, 2), r":(\d+)$", 1), F.lower(part(url, 1))
    return F.when((p == "") | ((scheme == "http") & (p == "80")) | ((scheme == "https") & (p == "443")), "").otherwise(F.concat(F.lit(":"), p))


def parameters(url: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(part(url, 4), r"^\?", ""), "&"), lambda x: x != "")


def without_tracking(url: Column) -> Column:
    """The query's parameters that don't track, sorted where no name occurs twice."""
    kept = F.filter(parameters(url), lambda p: ~F.lower(F.substring_index(p, "=", 1)).isin(TRACKING))
    names = F.transform(kept, lambda p: F.substring_index(p, "=", 1))
    return F.when(F.size(F.array_distinct(names)) == F.size(names), F.array_sort(kept)).otherwise(kept)


def normalized(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, no tracking parameters, no double slashes in the path."""
    path = F.regexp_replace(part(url, 3), "/{2,}", "/")
    path = F.when(path == "", "/").otherwise(path)
    query = F.array_join(without_tracking(url), "&")
    return F.when(host(url) == "", F.lit(None)).otherwise(F.concat(F.lower(part(url, 1)), F.lit("://"), host(url), port(url), path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def public(url: Column) -> Column:
    """Without user, query and fragment; empty if there is no host."""
    p = F.regexp_extract(part(url, 2), r":(\d+)$", 1)
    return F.when(host(url) == "", "").otherwise(F.concat(part(url, 1), F.lit("://"), host(url), F.when(p == "", "").otherwise(F.concat(F.lit(":"), p)), part(url, 3)))


def url_hash(url: Column, scheme_agnostic: bool = False) -> Column:
    """SHA-256 of scheme (or none), host, port if not the default, path and query; null for what is no URL."""
    path = F.when(part(url, 3) == "", "/").otherwise(part(url, 3))
    head = F.lit("//") if scheme_agnostic else F.concat(F.lower(part(url, 1)), F.lit("://"))
    query = F.regexp_replace(part(url, 4), r"^\?$", "")
    return F.when(host(url) == "", F.lit(None)).otherwise(F.sha2(F.concat(head, host(url), port(url), path, query), 256))


def page_number(url: Column) -> Column:
    """From the query (page, p, pg) or the path (/page/n); null if there is none."""
    in_query = F.regexp_extract(part(url, 4), r"[?&](?:page|p|pg)=(\d{1,9})(?:&|$)", 1)
    in_path = F.regexp_extract(part(url, 3), r"/page/(\d{1,9})(?:/|$)", 1)
    return F.coalesce(F.when(in_query != "", in_query.cast("long")), F.when(in_path != "", in_path.cast("long")))


def kind(url: Column) -> Column:
    """By the path's extension; a page if there is none that is known."""
    ext = F.lower(F.regexp_extract(part(url, 3), r"\.([A-Za-z0-9]{2,5})$", 1))
    out = F.when(F.lit(False), F.lit(""))
    for name, extensions in KINDS.items():
        out = out.when(ext.isin(extensions.split()), name)
    return out.otherwise("page")


def admission(url: Column, most_pages: int = 50) -> Column:
    """accept, or the first reason against."""
    return (
        F.when(host(url) == "", "invalid_url")
        .when(~F.lower(part(url, 1)).isin("http", "https"), "unsupported_scheme")
        .when(part(url, 2).contains("@"), "user_information")
        .when(host(url).rlike(r"^\d{1,3}(\.\d{1,3}){3}$|^\["), "ip_literal")
        .when(F.length(url) > 2048, "url_too_long")
        .when(page_number(url) > most_pages, "deep_pagination")
        .when(part(url, 3).rlike(r"(?i)\.(?:css|js|ico|woff2?|ttf|map)$"), "embedded_asset")
        .otherwise("accept")
    )


def without_dots(path: Column) -> Column:
    """A path from the root without . and .. segments."""
    parts = F.slice(F.split(path, "/"), 2, F.size(F.split(path, "/")))
    step = lambda out, p: F.when(p == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).when(p == ".", out).otherwise(F.concat(out, F.array(p)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    ends = F.element_at(parts, -1).isin(".", "..")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(ends & (F.size(kept) > 0), "/").otherwise(""))


def resolved(base: Column, reference: Column, most: int = 8192) -> Column:
    """A reference on a page as a whole URL. Null for a fragment alone, other schemes than http(s), more than ``most`` characters,
    backslashes, control characters, and a user in the authority."""
    ref = F.trim(reference)
    root = F.concat(F.lower(part(base, 1)), F.lit("://"), F.lower(part(base, 2)))
    folder = F.regexp_extract(part(base, 3), r"^(.*/)[^/]*$", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    path, rest = F.regexp_extract(ref, r"^([^?#]*)", 1), F.regexp_extract(ref, r"^[^?#]*(\?[^#]*)?", 1)
    rest = F.coalesce(rest, F.lit(""))
    whole = F.when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.regexp_extract(ref, r"^([^#]*)", 1)).when(ref.startswith("//"), F.concat(F.lower(part(base, 1)), F.lit(":"), F.regexp_extract(ref, r"^([^#]*)", 1)))
    whole = whole.when(path == "", F.concat(root, part(base, 3), rest)).when(path.startswith("/"), F.concat(root, without_dots(path), rest)).otherwise(F.concat(root, without_dots(F.concat(folder, path)), rest))
    bad = ref.isNull() | (ref == "") | ref.startswith("#") | (F.length(ref) > most) | ref.rlike(r"[\x00-\x1f\x7f\\]")
    return F.when(~bad & whole.rlike("(?i)^https?://[^/?#@]+(?:[/?#]|$)"), whole)


def asset_identity(url: Column) -> Column:
    """Without fragment and tracking parameters, the others in order, so that one asset has one."""
    kept = F.array_sort(F.filter(parameters(url), lambda p: ~F.lower(p).startswith("utm_") & ~F.lower(F.substring_index(p, "=", 1)).isin("fbclid", "gclid", "msclkid")))
    return F.concat(F.lower(part(url, 1)), F.lit("://"), host(url), port(url), part(url, 3), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
