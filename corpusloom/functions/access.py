"""Decision tables as CASE expressions: access controls, holds, policy, qualification, novelty, channel and outcome classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks of protection pages, and path segments that lead to a login or a paywall.
CAPTCHA = ("g-recaptcha", "h-captcha", "hcaptcha.com/1/api.js", "cf-turnstile", "captcha-delivery.com", "px-captcha")
CHALLENGE = ("_cf_chl_opt", "challenge-platform/h/", "just a moment...", "checking your browser")
LOGIN = ("login", "signin", "sign-in", "iniciar-sesion", "acceso", "auth", "account")
PAYWALL = ("paywall", "suscribete", "suscripcion", "subscribe", "subscription", "planes")


def _any(text: Column, marks: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | text.contains(m)
    return out


def response_class(status: Column, body: Column, mitigated: Column | None = None) -> Column:
    """What an answer shows about access; a challenge outranks the status. body: text; its first 64 K are read."""
    text = F.lower(F.substring(body, 1, 65536))
    read = status.isin(403, 429, 503) | (F.length(body) <= 32768)
    return (
        F.when(mitigated == "challenge" if mitigated is not None else F.lit(False), "bot_challenge").when(read & _any(text, CAPTCHA), "captcha").when(read & _any(text, CHALLENGE), "bot_challenge")
        .when(status.isin(403, 429, 503) & text.contains("attention required!") & text.contains("cloudflare"), "blocked").when(status.isin(401, 407), "auth_required").when(status == 403, "forbidden")
        .when(status == 451, "unavailable_for_legal_reasons").when(status == 429, "rate_limited").otherwise("none_observed")
    )


def redirect_class(path: Column) -> Column:
    names = F.split(F.lower(path), "/")
    return F.when(F.arrays_overlap(names, F.array(*map(F.lit, LOGIN))), "login_redirect").when(F.arrays_overlap(names, F.array(*map(F.lit, PAYWALL))), "paywall_redirect")


def hold_scope(kind: Column, access: Column) -> Column:
    """What an access control holds: the origin, that URL, or nothing."""
    holds = access.isin("auth_required", "forbidden", "unavailable_for_legal_reasons", "rate_limited", "captcha", "bot_challenge", "blocked")
    active = access.isin("captcha", "bot_challenge", "blocked", "unavailable_for_legal_reasons")
    return F.when(~holds, None).when(access == "rate_limited", "origin").when(kind == "robots_txt", F.when(active, "origin")).when(kind == "channel_document", "url").otherwise("origin")


def first_refusal(*rules: tuple[str, str, Column]) -> Column:
    """decision:reason of the first rule that fires, else ALLOW. rules: (DENY or DEFER, reason, condition)."""
    out = F.lit("ALLOW")
    for decision, reason, condition in reversed(rules):
        out = F.when(condition, f"{decision}:{reason}").otherwise(out)
    return out


def robots_pattern(rule: Column) -> Column:
    """A robots path pattern as a regular expression: * is any text, a final $ the end."""
    quoted = F.regexp_replace(rule, r"([.\\+?^(){}\[\]|])", r"\\$1")
    return F.concat(F.lit("^"), F.regexp_replace(F.regexp_replace(quoted, r"\*", ".*"), r"\$(?!$)", r"\\\$"))


def failure_category(reason: Column) -> Column:
    r = F.lower(reason)
    return F.when(r.isNull(), "none").when(r.contains("timeout") | r.contains("timed out"), "timeout").when(r.contains("dns") | r.contains("resolve"), "dns").when(r.contains("ssl") | r.contains("certificate"), "tls").when(r.contains("refused") | r.contains("reset"), "connection").when(r.rlike(r"\b4\d\d\b"), "http_4xx").when(r.rlike(r"\b5\d\d\b"), "http_5xx").otherwise("other")


def allowance(new_24h: Column) -> Column:
    """Requests an outlet may get in an hour: min(30, max(3, ceil(1.5 n / 24)))."""
    return F.least(F.lit(30), F.greatest(F.lit(3), F.ceil(1.5 * new_24h / 24)))


def novelty(first_listed: Column, published: Column, started: Column, first_poll_done: Column) -> Column:
    """What a candidate is to an intake that began at `started`: what its channel dates inside the window is new; what it dates
    before is older; without a date, the stock of its channel's first poll (done at first_poll_done, or not yet) is not new."""
    stock = first_poll_done.isNull() | (first_listed <= first_poll_done)
    return (
        F.when(first_listed < started, "known_before_intake").when(published.isNotNull(), F.when(published >= started, "new_dated_in_window").otherwise("older_than_window"))
        .when(stock, "first_poll_undated").otherwise("new_undated_later_poll")
    )


def weakest(*labels: Column) -> Column:
    """The weakest of measured, estimated and assumed."""
    rank = lambda c: F.when(c == "assumed", 2).when(c == "estimated", 1).otherwise(0)
    return F.element_at(F.array(F.lit("measured"), F.lit("estimated"), F.lit("assumed")), F.greatest(*map(rank, labels), F.lit(0)).cast("int") + 1)
