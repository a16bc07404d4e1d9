"""Cost functions of model and machine use, as columns. Prices are parameters: dollars per million tokens by model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: (input, output, cache read, cache write) per million tokens.
Prices = dict[str, tuple[float, float, float, float]]


def price(model: Column, prices: Prices, default: str, which: int) -> Column:
    """A model's price; unknown models cost what the default does."""
    table = F.create_map(*[F.lit(x) for m, p in prices.items() for x in (m, float(p[which]))])
    return F.coalesce(F.try_element_at(table, model), F.lit(float(prices[default][which])))


def usage_cost(model: Column, tokens_in: Column, tokens_out: Column, cache_read: Column, cache_write: Column, prices: Prices, default: str, input_has_cache_reads: bool = False) -> Column:
    """Dollars of a call. With `input_has_cache_reads`, cached tokens are also among the input tokens and are not paid twice."""
    zero = F.lit(0)
    fresh = F.coalesce(tokens_in, zero) - (F.coalesce(cache_read, zero) if input_has_cache_reads else zero)
    parts = (fresh, F.coalesce(tokens_out, zero), F.coalesce(cache_read, zero), F.coalesce(cache_write, zero))
    return sum((n * price(model, prices, default, k) for k, n in enumerate(parts)), start=F.lit(0.0)) / 1_000_000


def image_tokens(width: Column, height: Column) -> Column:
    return F.ceil(width * height / 750)


#: Tokens of a page's prompt and of its expected answer, for projections (fixed values).
PROMPT_TOKENS, ANSWER_TOKENS = 400, 1500


def projected_page_cost(width: Column, height: Column, model: Column, prices: Prices, default: str) -> Column:
    tokens_in = image_tokens(width, height) + PROMPT_TOKENS
    return (tokens_in * price(model, prices, default, 0) + ANSWER_TOKENS * price(model, prices, default, 1)) / 1_000_000


def machine_cost(hourly: Column, seconds: Column) -> Column:
    """Dollars of machine time; NULL for an unknown rate."""
    return F.round(hourly * seconds / 3600, 4)


def retry_delay(attempt: Column, base: float = 1.0, most: float = 60.0, jitter: Column | None = None) -> Column:
    """Seconds before the next attempt: doubling up to a limit, with up to half of it as jitter (a column from 0 to 1)."""
    wait = F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt))
    return wait if jitter is None else wait * (1 + 0.5 * jitter)
