"""Settings files and the connector options they stand for."""

from __future__ import annotations

import re

# Settings passed on to the connector.
SOURCE_KEYS = ["kafka.max.partition.fetch.bytes", "kafka.max.poll.records"]
SINK_KEYS = [
    "kafka.acks",
    "kafka.retries",
    "kafka.batch.size",
    "kafka.linger.ms",
    "kafka.max.request.size",
    "kafka.compression.type",
]

_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "f": "\f"}


def _plain(text: str) -> str:
    def one(match: re.Match) -> str:
        code = match.group(1)
        return chr(int(code[1:], 16)) if len(code) == 5 else _ESCAPES.get(code, code)

    return re.sub(r"\\(u[0-9a-fA-F]{4}|.)", one, text)


def parse_settings(text: str) -> dict[str, str]:
    """Key-value pairs of a `.properties` text."""
    joined = re.sub(r"(?m)^[ \t\f]*[#!].*$", "", text)
    joined = re.sub(r"(?<!\\)((?:\\\\)*)\\\r?\n[ \t\f]*", r"\1", joined)
    settings = {}
    for line in joined.splitlines():
        line = line.lstrip(" \t\f")
        if line:
            key, value = re.match(r"((?:\\.|[^\\=: \t\f])*)[ \t\f]*[=:]?[ \t\f]*(.*)", line).groups()
            settings[_plain(key)] = _plain(value)
    return settings


def load_settings(path: str) -> dict[str, str]:
    with open(path, encoding="latin-1") as file:
        return parse_settings(file.read())


def _passed(settings: dict[str, str], keys: list[str]) -> dict[str, str]:
    return {key: settings[key] for key in keys if key in settings}


def source_options(settings: dict[str, str]) -> dict[str, str]:
    """Options of the streaming read; no start offset, so the default holds."""
    return {
        "kafka.bootstrap.servers": settings["kafka.bootstrap.servers"],
        "subscribe": settings["kafka.topic"],
        **_passed(settings, SOURCE_KEYS),
    }


def reader_options(settings: dict[str, str]) -> dict[str, str]:
    """Options of a plain consumer: its group, and where it starts."""
    options = {
        "kafka.bootstrap.servers": settings["kafka.bootstrap.servers"],
        "subscribe": settings["kafka.topic"],
        "startingOffsets": settings.get("kafka.auto.offset.reset", "latest"),
    }
    if "kafka.group.id" in settings:
        options["kafka.group.id"] = settings["kafka.group.id"]
    return options


def sink_options(settings: dict[str, str]) -> dict[str, str]:
    """Options of a write to the topic."""
    return {
        "kafka.bootstrap.servers": settings["kafka.bootstrap.servers"],
        "topic": settings["kafka.topic"],
        **_passed(settings, SINK_KEYS),
    }
