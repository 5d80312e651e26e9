"""Part of casebook."""
