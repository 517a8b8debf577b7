-- One row per time sample with the other channels at the same index.
-- A repeated (athlete, activity, channel, index) gets no index, which fails its athlete's check.
WITH wide AS (
  SELECT
    athlete_id,
    activity_id,
    index,
    count_if(channel = 'time') AS beats,
    count(*) = count(DISTINCT channel) AS once,
    max(data) FILTER (WHERE channel = 'time') AS time,
    max(data) FILTER (WHERE channel = 'altitude') AS altitude,
    max(data) FILTER (WHERE channel = 'cadence') AS cadence,
    max(data) FILTER (WHERE channel = 'distance') AS distance,
    max(data) FILTER (WHERE channel = 'grade_smooth') AS grade_smooth,
    max(data) FILTER (WHERE channel = 'heartrate') AS heartrate,
    max(latitude) FILTER (WHERE channel = 'latlng') AS latitude,
    max(longitude) FILTER (WHERE channel = 'latlng') AS longitude,
    max(data) FILTER (WHERE channel = 'power') AS power,
    max(data) FILTER (WHERE channel = 'moving') AS moving,
    max(data) FILTER (WHERE channel = 'temp') AS temperature,
    max(data) FILTER (WHERE channel = 'velocity_smooth') AS velocity_smooth,
    max(data) FILTER (WHERE channel = 'watts') AS watts
  FROM IDENTIFIER(:schema || 'samples')
  GROUP BY athlete_id, activity_id, index
),
facts AS (
  SELECT athlete_id, activity_id, max(struct(name, sport_type)) AS fact
  FROM IDENTIFIER(:schema || 'activity')
  GROUP BY athlete_id, activity_id
)
SELECT
  IF(w.once, w.index, NULL) AS index,
  w.time,
  w.altitude,
  w.cadence,
  w.distance,
  w.grade_smooth,
  w.heartrate,
  w.latitude,
  w.longitude,
  w.power,
  w.moving,
  w.temperature,
  w.velocity_smooth,
  w.watts,
  f.fact.name AS name,
  f.fact.sport_type AS sport_type,
  w.athlete_id,
  w.activity_id,
  CAST(:at AS TIMESTAMP) AS metadata_insert_timestamp
FROM wide w
LEFT JOIN facts f ON f.athlete_id = w.athlete_id AND f.activity_id = w.activity_id
WHERE w.beats > 0
