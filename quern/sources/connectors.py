"""The interface of download connectors. Fetching is not a Spark concern; a connector turns a source row into file URLs.

Retries and resumption belong to the transport that a deployment brings; plan() only says what to fetch.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Fetch:
    source_ref: str
    url: str
    file: str


Connector = Callable[[dict], list[Fetch]]
_CONNECTORS: list[tuple[Callable[[dict], bool], Connector]] = []


def connector(supports: Callable[[dict], bool]):
    """Registers a connector; the first that supports a source is used."""

    def add(f: Connector) -> Connector:
        _CONNECTORS.append((supports, f))
        return f

    return add


def _has(pattern: str) -> Callable[[dict], bool]:
    return lambda s: re.search(pattern, s.get("url") or "") is not None


@connector(_has(r"huggingface\.co/datasets/"))
def hub_dataset(source: dict, most_files: int = 3) -> list[Fetch]:
    """The smallest listed data files, at most most_files of them (a setting of the connector)."""
    name = re.search(r"datasets/([^/]+/[^/]+)", source["url"])[1]
    files = sorted((f for f in source.get("files", []) if re.search(r"\.(parquet|jsonl?)(\.gz)?$", f["path"])), key=lambda f: (f.get("size", 0), f["path"]))
    return [Fetch(source["id"], f"https://huggingface.co/datasets/{name}/resolve/main/{f['path']}", f["path"].rsplit("/", 1)[-1]) for f in files[:most_files]]


@connector(_has(r"arxiv\.org/"))
def arxiv(source: dict) -> list[Fetch]:
    paper = re.search(r"(?:abs|pdf)/([^/?#]+?)(?:\.pdf)?$", source["url"])[1]
    return [Fetch(source["id"], f"https://arxiv.org/pdf/{paper}.pdf", f"{paper}.pdf"), Fetch(source["id"], f"https://export.arxiv.org/api/query?id_list={paper}", f"{paper}.xml")]


@connector(_has(r"github\.com/"))
def github(source: dict) -> list[Fetch]:
    owner, repo = re.search(r"github\.com/([^/]+)/([^/?#]+)", source["url"]).groups()
    repo = repo.removesuffix(".git")
    return [Fetch(source["id"], f"https://codeload.github.com/{owner}/{repo}/tar.gz/{source.get('ref', 'HEAD')}", f"{repo}.tar.gz")]


@connector(_has(r"stackexchange|stackoverflow"))
def stackexchange(source: dict) -> list[Fetch]:
    return [Fetch(source["id"], source.get("dump_url") or source["url"], f"{source['id']}.7z" if source.get("dump_url") else f"{source['id']}.html")]


@connector(lambda s: (s.get("url") or "").startswith("http"))
def page(source: dict) -> list[Fetch]:
    return [Fetch(source["id"], source["url"], f"{source['id']}.html")]


def plan(source: dict) -> list[Fetch]:
    """What to fetch for a source; nothing if no connector supports it."""
    for supports, f in _CONNECTORS:
        if supports(source):
            return f(source)
    return []
