"""python -m corpusmill VERB ...

  config URL YAML                     the rules that a site resolves to
  pipeline URL YAML OUT [MAX]         discover and extract a site's articles
  bulk LANGUAGE YAML OUT [MAX]        the same for all sites of a language, or `all`
  corpus FOLDER LANGUAGE OUT [SOURCES] the unified corpus of collected rows; sources by commas
  social KIND RAW OUT                 records of raw API bodies: vk (domain, body), comments (post_id, body)
  wiki DUMP PROJECT OUT [LEAST]       the articles of a dump, such as ttwiki's
  docs FOLDER OUT                     the texts of a folder's files
  build-vk FOLDER OUT [LANGUAGE]      posts with their comments
  query NAME SF_DIR [OUT]             a registered query: its rows, or as Parquet
"""

from __future__ import annotations

import json
import sys

from . import jobs
from .operators import config as C, social
from .plans import registry
from .session import local_session
from .sources.files import write_jsonl


def show_config(url: str, path: str) -> None:
    loaded = C.load(path)
    print(json.dumps(C.resolve(loaded, jobs.site_key(loaded, url)), ensure_ascii=False, indent=1, default=str))


def run_pipeline(url: str, path: str, out: str, most: str = "10000") -> None:
    write_jsonl(jobs.pipeline(local_session(), url, C.load(path), int(most)), out)


def run_bulk(language: str, path: str, out: str, most: str = "10000") -> None:
    for key, url in jobs.starts(C.load(path), language).items():
        run_pipeline(url, path, f"{out}/{key}", most)


def run_corpus(folder: str, language: str, out: str, sources: str = "news,social,wiki,docs") -> None:
    write_jsonl(jobs.corpus(local_session(), folder, language, tuple(sources.split(","))), out)


def run_social(kind: str, raw: str, out: str) -> None:
    spark = local_session()
    if kind == "vk":
        write_jsonl(social.vk_posts(spark.read.schema("domain string, body string").json(raw)), out)
    elif kind == "comments":
        write_jsonl(social.vk_comments(spark.read.schema("post_id long, body string").json(raw)), out)
    else:
        raise SystemExit(f"no such kind: {kind}")


def run_wiki(dump: str, project: str, out: str, least: str = "100") -> None:
    write_jsonl(jobs.wiki(local_session(), dump, project, int(least)), out)


def run_docs(folder: str, out: str) -> None:
    write_jsonl(jobs.docs(local_session(), folder), out)


def run_build_vk(folder: str, out: str, language: str | None = None) -> None:
    write_jsonl(jobs.build_vk(local_session(), folder, language), out)


def run_query(name: str, sf_dir: str, out: str | None = None) -> None:
    if name not in (found := registry.queries()):
        raise SystemExit("Queries: " + " ".join(sorted(found)))
    df = found[name](local_session(), sf_dir)
    df.write.mode("overwrite").parquet(out) if out else df.show(20, truncate=80)


VERBS = {"config": show_config, "pipeline": run_pipeline, "bulk": run_bulk, "corpus": run_corpus, "social": run_social, "wiki": run_wiki, "docs": run_docs, "build-vk": run_build_vk, "query": run_query}


def main(args: list[str]) -> int:
    if args and args[0] in VERBS:
        verb, rest = VERBS[args[0]], args[1:]
    elif args and args[0] in registry.queries():
        verb, rest = run_query, args
    else:
        print(__doc__)
        return 2
    try:
        verb(*rest)
    except TypeError as e:
        if verb.__name__ not in str(e):
            raise
        print(__doc__)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
