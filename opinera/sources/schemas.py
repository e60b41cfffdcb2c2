"""Landing schemas of game and review records, and of stream events. Fields not listed are dropped on reading."""

# Field names and types of the landed JSON.
GAMES = (
    "appid int, collected_at string, source string, success boolean, data struct<type:string,name:string,steam_appid:int,"
    "required_age:string,is_free:boolean,developers:array<string>,publishers:array<string>,"
    "platforms:struct<windows:boolean,mac:boolean,linux:boolean>,categories:array<struct<id:int,description:string>>,"
    "genres:array<struct<id:string,description:string>>,price_overview:struct<currency:string,initial:bigint,final:bigint,"
    "discount_percent:int,initial_formatted:string,final_formatted:string>,package_groups:array<struct<name:string,title:string,"
    "is_recurring_subscription:string,subs:array<struct<packageid:int,option_text:string,option_description:string,"
    "can_get_free_license:string,is_free_license:boolean,price_in_cents_with_discount:bigint>>>>,"
    "release_date:struct<coming_soon:boolean,date:string>>"
)
REVIEW = (
    "struct<recommendationid:string,author:struct<steamid:string,num_games_owned:int,num_reviews:int,playtime_forever:int,"
    "playtime_last_two_weeks:int,playtime_at_review:int,last_played:bigint>,language:string,review:string,timestamp_created:bigint,"
    "timestamp_updated:bigint,voted_up:boolean,votes_up:int,votes_funny:int,weighted_vote_score:string,comment_count:int,"
    "steam_purchase:boolean,received_for_free:boolean,refunded:boolean,written_during_early_access:boolean>"
)
REVIEWS = f"appid int, game_name string, ingested_at string, page_number int, request_cursor string, review {REVIEW}"
REVIEW_EVENT = f"event_id string, event_type string, appid int, event_time string, produced_at string, payload {REVIEW}"
PLAYER_EVENT = "event_id string, event_type string, schema_version int, appid int, event_time string, produced_at string, payload struct<player_count:bigint>"
