from .scalar import (sigmoid, minmax_scale, minmax_inverse, dot, round_half_up,
                     parse_bar_time, reshape_steps)

__all__ = ["sigmoid", "minmax_scale", "minmax_inverse", "dot", "round_half_up",
           "parse_bar_time", "reshape_steps"]
