"""The rules, one record at a time: what the Spark operators must agree with."""

from __future__ import annotations


def dedup(records, registry=None, scope="topic"):
    """Flags in processing order; ``registry`` maps identity to first place and is updated."""
    registry = {} if registry is None else registry
    flags = []
    for partition, offset, key in records:
        if key is None:
            flags.append(None)
            continue
        ident = key if scope == "topic" else (partition, key)
        first = registry.setdefault(ident, (partition, offset))
        flags.append(first != (partition, offset))
    return flags


def flush(events):
    """Sorted content of one buffer from events in processing order."""
    buffer = {}
    for kind, ident, payload in events:
        buffer[f"{kind} {'null' if ident is None else ident}"] = (kind, ident, payload.upper())
    return [buffer[k] for k in sorted(buffer, key=lambda s: s.encode())]
