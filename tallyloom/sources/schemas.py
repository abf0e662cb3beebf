"""Schemas of the raw tables. Half-precision columns are read as float."""

from __future__ import annotations

USER_BASIC = (
    "uid int, gender tinyint, city string, model string, ram_capacity tinyint, ram_left_ratio float, "
    "rom_capacity smallint, rom_left_ratio float, colour string, font_size float, network string, "
    "carrier string, os float"
)
USER_BEHAVIOUR = (
    "uid int, boot_times int, a_times float, b_times float, c_times float, d_times float, e_times float, "
    "f_times float, f_sum int"
)
INSTALLED_LISTS = "uid int, apps string"
INSTALLED = "uid int, app string"
APP_CATEGORIES = "app string, category string"
USAGE_LOG = "uid int, app string, duration float, times float, use_date date"
LABELLED = "uid int, label tinyint"
UNLABELLED = "uid int"
