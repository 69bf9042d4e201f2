"""Recorded facts of the network: addresses, name servers, mail hosts, certificates. Nothing here opens a socket."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

TYPES = {"NS": 2, "MX": 15}
ANSWERS = "answers array<struct<priority:int,host:string>>, error string"
DEEPEST = 32


def addresses(a: Column, a_error: Column, aaaa: Column, aaaa_error: Column) -> Column:
    """struct(a, aaaa, error_a, error_aaaa): sorted distinct addresses; an error of A counts without A addresses, one of AAAA without any address."""
    none = F.array().cast("array<string>")
    four, six = (F.array_sort(F.array_distinct(F.coalesce(x, none))) for x in (a, aaaa))
    return F.struct(four.alias("a"), six.alias("aaaa"), F.when(F.size(four) == 0, a_error).alias("error_a"), F.when((F.size(four) == 0) & (F.size(six) == 0), aaaa_error).alias("error_aaaa"))


def dns_ok(known: Column, host: Column) -> Column:
    """Whether a host resolves: never an empty one, nor one without a recorded answer."""
    return F.when(F.coalesce(host, F.lit("")) == "", False).otherwise(F.coalesce(known, F.lit(False)))


def name_at(message: bytes, at: int) -> tuple[str, int]:
    """A domain name of a DNS message, and where what follows it stands. Pointers are followed DEEPEST times at most."""
    labels, after, jumps = [], None, 0
    while True:
        if at >= len(message):
            raise ValueError("the message ends within a name")
        size = message[at]
        if size >= 0xC0:
            if at + 1 >= len(message) or jumps >= DEEPEST:
                raise ValueError("a pointer leads nowhere")
            after = at + 2 if after is None else after
            at, jumps = struct.unpack_from("!H", message, at)[0] & 0x3FFF, jumps + 1
        elif size == 0:
            return ".".join(labels), at + 1 if after is None else after
        else:
            if at + 1 + size > len(message):
                raise ValueError("the message ends within a label")
            labels.append(message[at + 1 : at + 1 + size].decode("ascii", "replace"))
            at += 1 + size


def answers_of(message: bytes | None, kind: str) -> tuple[list[tuple[int | None, str]], str | None]:
    """(priority, host) of all records of a kind in the answer, authority and additional parts; or what is wrong with the message."""
    try:
        if message is None or len(message) < 12:
            raise ValueError("the message is shorter than a header")
        questions, *counts = struct.unpack_from("!4H", message, 4)
        at, out = 12, []
        for _ in range(questions):
            at = name_at(message, at)[1] + 4
        for _ in range(sum(counts)):
            at = name_at(message, at)[1]
            if at + 10 > len(message):
                raise ValueError("the message ends within a record")
            number, size = struct.unpack_from("!H6xH", message, at)
            at += 10
            if at + size > len(message):
                raise ValueError("the message ends within a record")
            if number == TYPES[kind]:
                if kind == "MX" and size < 3:
                    raise ValueError("a mail record is too short")
                priority = struct.unpack_from("!H", message, at)[0] if kind == "MX" else None
                host = name_at(message, at + 2 * (kind == "MX"))[0]
                out.append((priority, host or "."))
            at += size
        return out, None
    except ValueError as e:
        return [], str(e)


def dns_answers(message: Column, kind: str) -> Column:
    """struct(answers, error) of a binary DNS message."""

    @F.pandas_udf(ANSWERS)
    def decode(messages: pd.Series) -> pd.DataFrame:
        got = [answers_of(m, kind) for m in messages]
        return pd.DataFrame({"answers": [[{"priority": p, "host": h} for p, h in rows] for rows, _ in got], "error": [e for _, e in got]})

    return decode(message)


def question_of(host: str | None, kind: str, number: int) -> tuple[bytes | None, str | None]:
    """The bytes of a question for a host's records of a kind, recursion desired; or what is wrong with the name."""
    name, out = (host or "").rstrip(".").lower(), bytearray()
    try:
        for label in name.split(".") if name else ():
            wire = label.encode("idna")
            if not wire or len(wire) > 63:
                raise ValueError("a label is empty or too long")
            out += bytes([len(wire)]) + wire
    except ValueError:  # also what idna refuses
        return None, "a label is empty or too long"
    return struct.pack("!6H", number, 0x0100, 1, 0, 0, 0) + bytes(out) + b"\0" + struct.pack("!2H", TYPES[kind], 1), None


def dns_question(host: Column, kind: str, number: Column) -> Column:
    """struct(message, error) of a question; number: 0 to 65,535."""

    @F.pandas_udf("message binary, error string")
    def encode(hosts: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([question_of(h, kind, int(n)) for h, n in zip(hosts, numbers)], columns=["message", "error"])

    return encode(host, number)


def merged_mx(records: Column) -> Column:
    """Mail hosts in lower case, without a final dot (a lone dot stays), distinct, by priority and host."""
    host = lambda h: F.when(h == ".", h).otherwise(F.regexp_replace(F.lower(h), r"\.+$", ""))
    return F.array_sort(F.array_distinct(F.transform(records, lambda r: F.struct(r["priority"].alias("priority"), host(r["host"]).alias("host")))))


def merged_ns(hosts: Column) -> Column:
    """Name servers in lower case, without final dots (the root stays a dot), blank ones out, sorted, distinct."""
    clean = F.transform(F.filter(hosts, lambda h: h.isNotNull() & (h != "")), lambda h: F.regexp_replace(F.lower(h), r"\.+$", ""))
    return F.array_sort(F.array_distinct(F.transform(clean, lambda h: F.when(h == "", ".").otherwise(h))))


def certificate(subject: Column, issuer: Column, dates: Column, names: Column) -> Column:
    """struct(subject_cn, issuer_cn, san, not_before, not_after) of the texts that a certificate tool prints; null, or an empty list, for what they don't say."""
    line = lambda text, word: F.regexp_extract(F.coalesce(text, F.lit("")), rf"(?im)^({word}=.*)$", 1)
    date = lambda word: T.cert_time(F.nullif(F.regexp_extract(F.coalesce(dates, F.lit("")), rf"{word}=(.+)", 1), F.lit("")))
    san = F.coalesce(T.alternative_names(names), F.array().cast("array<string>"))
    return F.struct(T.common_name(line(subject, "subject")).alias("subject_cn"), T.common_name(line(issuer, "issuer")).alias("issuer_cn"), san.alias("san"), date("notBefore").alias("not_before"), date("notAfter").alias("not_after"))


def partial(errors: list[Column]) -> Column:
    """Whether any part of a fingerprint failed."""
    return F.greatest(*(e.isNotNull() for e in errors)) if len(errors) > 1 else errors[0].isNotNull()
