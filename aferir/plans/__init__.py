"""Raw -> cleaned (silver) -> analytic (gold) builds, one module per indicator."""
