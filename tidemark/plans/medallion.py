"""Bronze to published Gold: build, test, publish.

Every product is written once, out of sight, and its row tests are observed
during that write, so 100 TB of Silver is neither scanned again for tests nor
cached. Gold reads the written Silver and so only the columns it needs. The
tables are repointed only after every contract and test has passed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.masking import MaskingKey, assert_salt
from tidemark.operators import quality
from tidemark.operators.governance import mask_sensitive
from tidemark.plans.products import PRODUCT_LINES, Product
from tidemark.sources.lakehouse import Lakehouse, Staged


def _check_schema(df: DataFrame, product: Product) -> None:
    violations = quality.contract_violations(df.schema, product.contract)
    if violations:
        raise quality.ContractError(f"{product.name} breaks its contract: {violations}")
    leaked = quality.forbidden_columns(df, product.tests.forbidden)
    if leaked:
        raise quality.QualityError(f"{product.name} carries forbidden columns: {leaked}")


def build_product(lake: Lakehouse, product: Product, source: DataFrame) -> Staged:
    """Build, check and stage one product; raises before anything is visible."""
    df = product.build(source)
    _check_schema(df, product)
    tests = quality.row_test_metrics(product.tests)
    staged = lake.stage(
        product.tier,
        product.name,
        df,
        metrics=[column.alias(name) for name, column in tests.items()],
        expected_schema=product.contract,
    )
    failing = {name: count for name, count in staged.metrics.items() if count}
    written = lake.staged_frame(staged)
    for column in product.tests.unique:
        count = quality.test_unique(written, column).first()["failing"]
        if count:
            failing[f"unique:{column}"] = count
    if failing:
        raise quality.QualityError(f"{product.name} failed its data tests: {failing}")
    return staged


def ingest(lake: Lakehouse, raw: DataFrame, salt: str | None = None) -> int:
    """Mask the sensitive columns and append to Bronze; returns rows written."""
    profile = lake.profile
    masked = mask_sensitive(raw, profile, MaskingKey(lake.spark, salt))
    return lake.append_product("bronze", profile.bronze_table, masked, profile.schema)


def enforce(lake: Lakehouse, salt: str | None = None) -> dict[str, int]:
    """Build both products from Bronze, test them, publish; rows per table."""
    assert_salt(salt)
    line = PRODUCT_LINES[lake.profile.name]
    bronze = lake.read_product("bronze", lake.profile.bronze_table)
    silver = build_product(lake, line.silver, bronze)
    gold = build_product(lake, line.gold, lake.staged_frame(silver))
    return lake.publish_tiers([silver, gold])
