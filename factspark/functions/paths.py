"""Functions on file paths and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factspark.functions.strings import let, strip, title_case

UNKNOWN_SOURCE = "unknown"


def path_source(path: Column, explicit: Column | None = None) -> Column:
    """The source a record came from.

    An explicit source wins unless blank; else it is the first folder (or file)
    below the first ``/raw/`` in the path; else ``unknown``. A ``.json`` ending stays.
    """
    below_raw = F.regexp_extract(F.lower(path), r"/raw/+([^/]+)", 1)
    found = F.coalesce(strip(F.nullif(below_raw, F.lit(""))), F.lit(UNKNOWN_SOURCE))
    if explicit is None:
        return found
    return F.coalesce(F.nullif(F.lower(strip(explicit)), F.lit("")), found)


def parent_dir(path: Column) -> Column:
    """The name of the folder a file lies in."""
    return F.regexp_extract(path, r"(?s)^(?:.*/)?([^/]+)/[^/]+$", 1)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^(?:.*/)?([^/]+)$", 1)


def decode_blanks(c: Column) -> Column:
    """``%20`` to a blank; other escapes stay (``url_decode`` would also change ``+``)."""
    return F.regexp_replace(c, "%20", " ")


def url_slug(url: Column) -> Column:
    """The last path segment, trailing slashes ignored; query strings stay."""
    return base_name(F.rtrim(url, F.lit("/")))


def slug_file(url: Column, folder: str) -> Column:
    """The JSON file a page is stored in."""
    return F.concat(F.lit(folder.rstrip("/") + "/"), url_slug(url), F.lit(".json"))


def slug_title(url: Column) -> Column:
    """A title made from the text after the last slash; empty where the URL ends with one."""
    last = F.regexp_extract(url, r"([^/]*)$", 1)
    return title_case(F.replace(last, F.lit("-"), F.lit(" ")))


def safe_file_name(title: Column) -> Column:
    return F.replace(title, F.lit("/"), F.lit("_"))


def resolve_url(base: Column, link: Column) -> Column:
    """An absolute URL for a link found on the page ``base``.

    An empty link is the base, absolute links stay; ``//host/x``, ``/x``, ``?x``, ``#x``
    and relative links are joined to the base, and dot segments are folded.
    """
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    path = F.regexp_extract(link, r"^([^?#]*)", 1)
    rest = F.substr(link, F.length(path) + 1)
    own_path = F.substr(page, F.length(origin) + 1)
    joined = let(_merged(own_path, path), _folded)
    return (
        F.when(link == "", base)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("?"), F.concat(page, link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .otherwise(F.concat(origin, joined, rest))
    )


def _merged(own: Column, path: Column) -> Column:
    """The segments of a link's path; of a relative one behind its page's folder, without empty ones inside."""
    folder = F.split(F.regexp_extract(own, r"(?s)^(.*/)?", 1), "/", -1)
    folder = F.slice(folder, 1, F.greatest(F.size(folder) - 1, F.lit(0)))
    relative = let(
        F.concat(folder, F.split(path, "/", -1)),
        lambda all_: F.filter(all_, lambda s, i: (s != "") | (i == 0) | (i == F.size(all_) - 1)),
    )
    return F.when(path.startswith("/"), F.split(path, "/", -1)).otherwise(relative)


def _folded(segments: Column) -> Column:
    """Segments as a path that starts with a slash, after ``.`` and ``..`` took effect."""
    kept = F.reduce(
        segments,
        F.slice(segments, 1, 0),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    ends_open = F.element_at(segments, -1).isin(".", "..")
    path = F.concat(F.array_join(kept, "/"), F.when(ends_open, "/").otherwise(""))
    return F.concat(F.when(path.startswith("/"), "").otherwise("/"), path)


def search_term(name: Column) -> Column:
    """A name as it stands in a search URL."""
    return F.lower(F.replace(name, F.lit(" "), F.lit("+")))


# The public literature service the fetch lists address.
EUTILS = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils/"


def search_url(term: Column) -> Column:
    """Search request for a term; the access key is added by whoever fetches."""
    return F.concat(
        F.lit(f"{EUTILS}esearch.fcgi?db=pubmed&term="), term, F.lit("+AND+cat&retmax=9999")
    )


def article_url(article_id: Column) -> Column:
    return F.concat(F.lit(f"{EUTILS}efetch.fcgi?db=pubmed&id="), article_id, F.lit("&retmode=xml"))


def wiki_url(title: Column) -> Column:
    return F.concat(F.lit("https://en.wikipedia.org/wiki/"), title)
