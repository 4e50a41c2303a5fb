"""The reports as Spark SQL on registered views, with named parameters.

Run with ``spark.sql(STATEMENTS[name], args)``.
"""

from __future__ import annotations

from hourlake.functions import rounding


def _means(source: str, key: str, scales: dict[str, int]) -> str:
    """``source`` (a named query) with the exact mean of some columns by ``key``, as SQL."""
    columns, first = list(scales), "coalesce(place, 0) = 0"
    kinds = {"sum": rounding.ordinary_sum, "n": rounding.value_count, "marks": rounding.marks}
    states = ", ".join(f"{text(c, first)} AS {kind}_{c}" for c in columns for kind, text in kinds.items())
    folds = {"sum": "sum", "n": "sum", "marks": "bit_or"}
    merged = ", ".join(f"{fold}({kind}_{c}) AS {kind}_{c}" for c in columns for kind, fold in folds.items())
    results = ",\n".join(
        rounding.result(i, f"sum_{c}", f"n_{c}", f"marks_{c}", "bands", scale, True) + f" AS average_{c}"
        for i, (c, scale) in enumerate(scales.items())
    )
    return f"""large_values AS (
            SELECT *, posexplode_outer({rounding.large_values(columns)}) AS (place, large) FROM {source}
        ), states AS (
            SELECT {key}, large.slot, large.band, sum(large.digits) AS large_sum, {states}
            FROM large_values GROUP BY {key}, large.slot, large.band
        ), merged AS (
            SELECT {key}, collect_list(CASE WHEN large_sum <> 0 THEN
                struct(slot, band, large_sum AS sum) END) AS bands, {merged}
            FROM states GROUP BY {key}
        )
        SELECT {key}, {results} FROM merged"""


STATEMENTS = {
    "preview_daily": """
        SELECT * FROM daily_weather_summary
        ORDER BY city, date, forecast_data LIMIT 30
    """,
    "daily_extremes": """
        SELECT city, max_temperature_2m, min_temperature_2m
        FROM daily_weather_summary
        WHERE date = :date AND NOT forecast_data
    """,
    "city_averages": """
        WITH fall AS (
            SELECT city, date, hour, snowfall, rain
            FROM hourly_precipitation_evaporation WHERE NOT forecast_data
        ), air AS (
            SELECT city, date, hour, surface_pressure, wind_speed_10m
            FROM hourly_wind_atmospheric_conditions WHERE NOT forecast_data
        ), hours AS (
            SELECT * FROM fall JOIN air USING (city, date, hour)
        ), """
    + _means("hours", "city", {"snowfall": 6, "rain": 6, "surface_pressure": 4, "wind_speed_10m": 4}),
    "temperatures": """
        SELECT temperature_2m, temperature_80m, temperature_120m
        FROM hourly_weather_conditions
        WHERE forecast_data = :forecast AND date = :date AND city = :city
    """,
    "day_over_day_city": """
        WITH chosen AS (
            SELECT * FROM hourly_weather_conditions WHERE city = :city
        ), forecast AS (
            SELECT hour, temperature_2m AS low, temperature_80m AS middle, temperature_120m AS high
            FROM chosen WHERE forecast_data AND date = :first_date
        ), observed AS (
            SELECT hour, temperature_2m AS low_seen, temperature_80m AS middle_seen,
                   temperature_120m AS high_seen
            FROM chosen WHERE NOT forecast_data AND date = :second_date
        )
        SELECT hour, low - low_seen AS temperature_diff_2m,
               middle - middle_seen AS temperature_diff_80m,
               high - high_seen AS temperature_diff_120m
        FROM forecast JOIN observed USING (hour)
    """,
    "wide_report": """
        WITH soil AS (
            SELECT city, date, hour, soil_temperature_0cm, soil_temperature_6cm, soil_temperature_18cm
            FROM hourly_soil_conditions
            WHERE forecast_data AND city = :city AND date BETWEEN :first_date AND :last_date
        ), wind AS (
            SELECT city, date, hour, wind_speed_10m, wind_speed_80m, wind_speed_120m
            FROM hourly_wind_atmospheric_conditions
            WHERE forecast_data AND city = :city AND date BETWEEN :first_date AND :last_date
        ), indices AS (
            SELECT city, date, hour, heat_index, wind_chill, precipitation_rate,
                   potential_evapotranspiration, atmospheric_pressure_diff
            FROM meteorological_calculations
            WHERE forecast_data AND city = :city AND date BETWEEN :first_date AND :last_date
        ), air AS (
            SELECT city, date, hour, temperature_2m, temperature_80m, temperature_120m
            FROM hourly_weather_conditions
            WHERE forecast_data AND city = :city AND date BETWEEN :first_date AND :last_date
        )
        SELECT city, date, hour,
               temperature_2m, temperature_80m, temperature_120m,
               soil_temperature_0cm, soil_temperature_6cm, soil_temperature_18cm,
               wind_speed_10m, wind_speed_80m, wind_speed_120m,
               heat_index, wind_chill, precipitation_rate,
               potential_evapotranspiration, atmospheric_pressure_diff
        FROM air JOIN soil USING (city, date, hour) JOIN wind USING (city, date, hour)
             JOIN indices USING (city, date, hour)
        ORDER BY date NULLS LAST, hour NULLS LAST
    """,
    # every published table side by side, the daily one by city, date and half
    "all_tables": """
        SELECT city, date, hour, forecast_data,
               m.heat_index, p.precipitation, s.soil_temperature_0cm,
               h.temperature_2m, w.pressure_msl,
               d.max_temperature_2m, d.total_precipitation
        FROM meteorological_calculations m
        JOIN hourly_precipitation_evaporation p USING (city, date, hour, forecast_data)
        JOIN hourly_soil_conditions s USING (city, date, hour, forecast_data)
        JOIN hourly_weather_conditions h USING (city, date, hour, forecast_data)
        JOIN hourly_wind_atmospheric_conditions w USING (city, date, hour, forecast_data)
        JOIN daily_weather_summary d USING (city, date, forecast_data)
    """,
}
