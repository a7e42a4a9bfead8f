"""Feature specification: the logical schema of a pipeline, declared by config."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of a tabular regression dataset.

    ``num`` and ``cat`` are ordered; the contract column order of a cleaned
    frame is ``cat + num + [target] + [id_col]``.
    """

    num: tuple[str, ...]
    cat: tuple[str, ...]
    target: str
    id_col: str = "Id"
    # numeric columns imputed with the mean of the whole frame
    mean_fill: tuple[str, ...] = ()
    # numeric columns imputed with a constant
    constant_fill: dict[str, float] = field(default_factory=dict)
    # extra columns coerced to numbers although they are not features
    extra_numeric: tuple[str, ...] = ()
    # text written into missing categorical cells
    category_fill: str = "None"

    @property
    def features(self) -> list[str]:
        """Model input columns: numeric first, then categorical."""
        return [*self.num, *self.cat]

    @property
    def contract_columns(self) -> list[str]:
        return [*self.cat, *self.num, self.target, self.id_col]


# Column roles and imputation rules of the original house-sale data
# (numeric features, categorical features, target, imputation rules).
HOUSE_SPEC = FeatureSpec(
    num=(
        "LotFrontage", "LotArea", "OverallQual", "OverallCond", "YearBuilt",
        "YearRemodAdd", "MasVnrArea", "TotalBsmtSF", "GrLivArea", "GarageCars",
    ),
    cat=(
        "MSZoning", "Street", "Alley", "LotShape", "LandContour", "Neighborhood",
        "Condition1", "BldgType", "HouseStyle", "RoofStyle", "Exterior1st",
        "Exterior2nd", "MasVnrType", "Foundation", "Heating", "CentralAir",
        "SaleType", "SaleCondition",
    ),
    target="SalePrice",
    id_col="Id",
    mean_fill=("LotFrontage",),
    constant_fill={"MasVnrArea": 0.0},
    extra_numeric=("GarageYrBlt",),
)

# Gradient-boosting parameters of the original configuration.
GBT_PARAMS = {"learning_rate": 0.01, "n_estimators": 1000, "max_depth": 6, "force_row_wise": True}
