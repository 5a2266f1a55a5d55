-- How far delays scatter around their mean, per carrier.
SELECT carrier,
       count(*)                       AS flight_count,
       avg(arr_delay_minutes)         AS avg_arr_delay,
       avg(dep_delay_minutes)         AS avg_dep_delay,
       stddev_samp(arr_delay_minutes) AS std_arr_delay,
       stddev_samp(dep_delay_minutes) AS std_dep_delay,
       cast(coalesce(cast(:at AS timestamp), current_timestamp()) AS timestamp_ntz) AS built_at
FROM identifier(:silver || '.aviation_flights')
GROUP BY carrier
