from recspark.functions.exprs import (
    year_start, safe_div, r6, clip, day_number, hist_bin, mix_key, fold_of,
    lehmer_uniform, std_normal,
)

__all__ = ["year_start", "safe_div", "r6", "clip", "day_number", "hist_bin", "mix_key",
           "fold_of", "lehmer_uniform", "std_normal"]
