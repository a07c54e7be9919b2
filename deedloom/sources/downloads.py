"""Fetching source files over HTTP: plain Python beside the engine, for machines with a network."""

from __future__ import annotations

import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from pathlib import Path

#: Bytes read at a time.
CHUNK = 1 << 20


@dataclass
class Downloader:
    """Streams files to a folder, skipping those there; connection failures are tried again after 1, 2, 4, ... seconds."""

    folder: Path
    headers: dict[str, str] = field(default_factory=dict)
    tries: int = 4
    pause: float = 0.0
    opener: Callable[[urllib.request.Request], object] = urllib.request.urlopen
    sleep: Callable[[float], None] = time.sleep

    def open(self, url: str):  # noqa: ANN201
        for k in range(self.tries):
            try:
                return self.opener(urllib.request.Request(url, headers=self.headers))
            except urllib.error.HTTPError:
                raise
            except (urllib.error.URLError, ConnectionError, TimeoutError):
                if k + 1 == self.tries:
                    raise
                self.sleep(2.0**k)
        raise AssertionError("unreachable")

    def fetch(self, url: str, name: str | None = None) -> Path:
        """The file at a URL; a part of it is never left under its name."""
        to = self.folder / (name or url.rsplit("/", 1)[-1].split("?")[0])
        if to.exists():
            return to
        self.folder.mkdir(parents=True, exist_ok=True)
        part = to.with_name(to.name + ".part")
        with self.open(url) as response, part.open("wb") as f:
            while data := response.read(CHUNK):
                f.write(data)
        part.rename(to)
        return to

    def fetch_all(self, files: Iterable[tuple[str, str]], confirm: Callable[[list[str]], bool] = lambda _: True) -> list[Path]:
        """Files as (url, name), after a yes to their names; with a pause between two."""
        listed = list(files)
        if not confirm([n for _, n in listed]):
            return []
        out = []
        for k, (url, name) in enumerate(listed):
            if k and self.pause:
                self.sleep(self.pause)
            out.append(self.fetch(url, name))
        return out


def newest_first(names: Iterable[str], pattern: str) -> list[str]:
    """Names that hold a pattern, last in the alphabet first (dated names: newest first)."""
    return sorted((n for n in names if re.search(pattern, n)), reverse=True)


def listed_in_xml(text: str, tag: str = "Name", contains: str = "", suffix: str = "") -> list[str]:
    """Texts of a tag in an XML listing that hold one string and end with another."""
    found = re.findall(rf"<{tag}>([^<]*)</{tag}>", text)
    return [n for n in found if contains in n and n.endswith(suffix)]
