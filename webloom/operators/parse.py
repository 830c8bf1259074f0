"""The parse pass: one Arrow-batched worker call per batch of pages.

``extract_parts`` appends raw parts (title, metas, hrefs, resolved links,
content-root text / inner HTML / Markdown, monitor text) to a DataFrame that
carries a URL and an HTML column. Everything downstream is native column
expressions. Only the requested parts are computed, and callers select the
columns they need *before* this call: Catalyst cannot prune or push filters
through an opaque Arrow function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from webloom.functions.selectors import Selector
from webloom.session import spread

_S = T.StringType()
_AS = T.ArrayType(T.StringType())

PART_FIELDS = {
    "title": [("title_raw", _S)],
    "meta": [("meta_description", _S), ("meta_og_description", _S), ("meta_og_image", _S),
             ("meta_author", _S), ("meta_published_time", _S), ("time_datetime", _S)],
    "links": [("hrefs", _AS), ("hrefs_resolved", _AS), ("links", _AS)],
    "root": [("root_tag", _S)],
    "html": [("content_html", _S)],
    "text": [("content_text_raw", _S)],
    "markdown": [("content_markdown", _S)],
    "monitor": [("monitor_text_raw", _S)],
}


def extract_parts(df: DataFrame, parts, html_col: str = "html", url_col: str = "url",
                  selector: str | None = None, drop_html: bool = True) -> DataFrame:
    parts = [p for p in PART_FIELDS if p in set(parts)]
    if selector is not None:
        Selector(selector)  # reject unsupported selectors on the driver
    keep = [f for f in df.schema.fields if not (drop_html and f.name == html_col)]
    added = [T.StructField(n, t, True) for p in parts for (n, t) in PART_FIELDS[p]]
    out_schema = T.StructType(keep + added)
    keep_names = [f.name for f in keep]
    added_names = [f.name for f in added]
    want = set(parts)

    def run(batches):
        import pyarrow as pa

        from webloom.functions.html import Document, to_markdown
        from webloom.functions.selectors import Selector as Sel
        from webloom.functions.urls import resolve

        sel = Sel(selector) if selector is not None else None
        # Without Markdown or a selector the light scan (text events and
        # root candidates only) gives the same parts, faster.
        light = sel is None and "markdown" not in want
        list_t = pa.list_(pa.string())
        arrow_types = {"hrefs": list_t, "hrefs_resolved": list_t, "links": list_t}
        for batch in batches:
            htmls = batch.column(html_col).to_pylist()
            urls = batch.column(url_col).to_pylist()
            cols: dict[str, list] = {n: [] for n in added_names}
            for h, u in zip(htmls, urls):
                if h is None:
                    for n in added_names:
                        cols[n].append(None)
                    continue
                d = Document(h, sel, light=light)
                if "title" in want:
                    cols["title_raw"].append(d.title)
                if "meta" in want:
                    cols["meta_description"].append(d.meta("name", "description"))
                    cols["meta_og_description"].append(d.meta("property", "og:description"))
                    cols["meta_og_image"].append(d.meta("property", "og:image"))
                    cols["meta_author"].append(d.meta("name", "author"))
                    cols["meta_published_time"].append(
                        d.meta("property", "article:published_time"))
                    cols["time_datetime"].append(
                        d.first_time.attrs.get("datetime") if d.first_time is not None else None)
                if "links" in want:
                    cols["hrefs"].append(d.hrefs)
                    resolved = [resolve(x, u) for x in d.hrefs]
                    cols["hrefs_resolved"].append(resolved)
                    cols["links"].append([x for x in resolved if x is not None])
                root = d.content_root() if want & {"root", "html", "text", "markdown"} else None
                if "root" in want:
                    cols["root_tag"].append(
                        None if root is None else ("role" if root.attrs.get("role") == "main"
                                                   and root.tag not in ("main", "article", "body")
                                                   else root.tag))
                if "html" in want:
                    cols["content_html"].append(d.inner_html(root))
                if "text" in want:
                    cols["content_text_raw"].append(d.text_of(root))
                if "markdown" in want:
                    cols["content_markdown"].append(to_markdown(d, root))
                if "monitor" in want:
                    cols["monitor_text_raw"].append(d.text_of(d.monitor_root(), True))
            arrays = [batch.column(n) for n in keep_names]
            arrays += [pa.array(cols[n], type=arrow_types.get(n, pa.string()))
                       for n in added_names]
            yield pa.RecordBatch.from_arrays(arrays, names=keep_names + added_names)

    return spread(df, url_col).mapInArrow(run, out_schema)
