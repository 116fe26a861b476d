"""SQL dialects: upsert and delete statements of a row."""

from __future__ import annotations

import re
import urllib.parse


def _unique(names: list[str]) -> list[str]:
    return list(dict.fromkeys(names))


class Dialect:
    """``upsert(table, pk, cols)`` and ``delete(table, pk)``; values go in as
    parameters, key columns first. Table names are taken as they are."""

    quote_mark, style = '"', "qmark"

    def __init__(self, paramstyle: str = ""):
        self.style = paramstyle or self.style

    def quote(self, name: str) -> str:
        name = self.quote_mark + name.replace(self.quote_mark, self.quote_mark * 2) + self.quote_mark
        return name.replace("%", "%%") if self.style in ("format", "pyformat") else name

    def mark(self, number: int) -> str:
        """Mark of a parameter, as DB-API modules name the styles (``dollar`` besides)."""
        return {"qmark": "?", "format": "%s", "pyformat": "%s", "numeric": f":{number}", "dollar": f"${number}"}[self.style]

    def conflict(self, pk: list[str], cols: list[str]) -> str:
        raise NotImplementedError

    def upsert(self, table: str, pk: list[str], cols: list[str]) -> str:
        names = _unique([*pk, *cols])
        marks = ", ".join(self.mark(i + 1) for i in range(len(names)))
        rest = [c for c in names if c not in pk]
        return f"INSERT INTO {table} ({', '.join(map(self.quote, names))}) VALUES ({marks}) {self.conflict(pk, rest)}"

    def delete(self, table: str, pk: list[str]) -> str:
        return f"DELETE FROM {table} WHERE " + " AND ".join(f"{self.quote(c)} = {self.mark(i + 1)}" for i, c in enumerate(pk))


class Postgres(Dialect):
    style = "dollar"

    def conflict(self, pk: list[str], cols: list[str]) -> str:
        keys = ", ".join(map(self.quote, pk))
        if not cols:
            return f"ON CONFLICT ({keys}) DO NOTHING"
        return f"ON CONFLICT ({keys}) DO UPDATE SET " + ", ".join(f"{self.quote(c)} = EXCLUDED.{self.quote(c)}" for c in cols)


class Sqlite(Postgres):
    """The same statements with the parameter marks of the standard library's driver."""

    style = "qmark"


class MySql(Dialect):
    quote_mark = "`"

    def conflict(self, pk: list[str], cols: list[str]) -> str:
        return "ON DUPLICATE KEY UPDATE " + ", ".join(f"{self.quote(c)} = VALUES({self.quote(c)})" for c in cols or pk[:1])


DIALECTS = {"postgres": Postgres, "pgx": Postgres, "mysql": MySql, "sqlite": Sqlite}


def dialect(name: str, paramstyle: str = "") -> Dialect:
    try:
        return DIALECTS[name](paramstyle)
    except KeyError:
        raise ValueError(f"no dialect {name!r}; there are {', '.join(sorted(DIALECTS))}") from None


def parsed_dsn(dsn: str) -> dict:
    """``host, port, user, password, database`` (those that are given) of a connection
    text: a URL, or ``user:password@tcp(host:port)/database?...``."""
    if m := re.fullmatch(r"(?:([^:@/]*)(?::(.*))?@)?(?:tcp)?\(([^:()]*)(?::(\d+))?\)/([^?]*)(?:\?.*)?", dsn):
        user, password, host, port, database = m.groups()
    else:
        url = urllib.parse.urlsplit(dsn if "://" in dsn else f"//{dsn}")
        user, password = (urllib.parse.unquote(x) if x else x for x in (url.username, url.password))
        host, port, database = url.hostname, url.port, url.path.strip("/")
    found = {"host": host, "port": int(port) if port else None, "user": user, "password": password, "database": database}
    return {k: v for k, v in found.items() if v not in (None, "")}
