"""Text functions: symbols as file names, vendor errors, redaction, login links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REDACTED = "***REDACTED***"
# What follows these is secret.
SECRET_PATTERNS = (r"(?i)(auth_code=)[^&\s\"']+", r"(?i)(access_token=)[^&\s\"']+", r"(?i)(secret_key=)[^&\s\"']+", r'(?i)(appIdHash"?\s*[:=]\s*"?)[0-9a-f]{64}')
AUTH_CODES = (-15, -16, -17)
CODE_PARAMETERS = ("auth_code", "authcode", "code")


def safe_symbol(symbol: Column) -> Column:
    return F.translate(symbol, ":/", "__")


def scrub(text: Column, literals: tuple[str, ...] = ()) -> Column:
    """Known secrets of 8 characters or more, then secret-looking parameters, are redacted."""
    for literal in literals:
        if len(literal) >= 8:
            text = F.replace(text, F.lit(literal), F.lit(REDACTED))
    for pattern in SECRET_PATTERNS:
        text = F.regexp_replace(text, pattern, "$1" + REDACTED.replace("*", "\\*"))
    return text


def vendor_status(raw: Column) -> Column:
    """ok, auth, rate_limit or data_error for a payload's JSON text; the order of the tests matters."""
    keys = F.json_object_keys(raw)
    message = F.lower(F.coalesce(F.get_json_object(raw, "$.message"), F.lit("")))
    code = F.get_json_object(raw, "$.code").try_cast("int")
    has = lambda *parts: F.greatest(F.lit(False), *(F.contains(message, F.lit(p)) for p in parts))
    return (
        F.when(keys.isNull(), "data_error")
        .when(F.coalesce(F.get_json_object(raw, "$.s") == "ok", F.lit(False)), F.when(F.array_contains(keys, "candles"), "ok").otherwise("data_error"))
        .when(has("token", "auth") | F.coalesce(code.isin(*AUTH_CODES), F.lit(False)), "auth")
        .when(has("rate", "limit", "too many"), "rate_limit")
        .otherwise("data_error")
    )


def auth_code(url: Column) -> Column:
    """The login code in a link's query: the first parameter present, decoded; blank ones don't count."""
    value = lambda name: F.nullif(F.trim(F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit(name)))), F.lit(""))
    return F.coalesce(*map(value, CODE_PARAMETERS))


def access_token(raw: Column) -> Column:
    return F.coalesce(F.get_json_object(raw, "$.access_token"), F.get_json_object(raw, "$.accessToken"))


def authorization_header(client: Column, token: Column) -> Column:
    return F.concat_ws(":", client, token)


def run_id() -> Column:
    return F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 12)


def trading_mode(text: Column) -> Column:
    """paper for blank or paper; anything else is refused."""
    mode = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return F.when(mode.isin("", "paper"), "paper").otherwise(F.raise_error(F.concat(F.lit("trading mode refused: "), mode)))


def sha256_hex(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, in lower-case hexadecimal digits."""
    return F.sha2(text, 256)
